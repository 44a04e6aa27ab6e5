"""Accuracy and correction queries.

Predictions are deterministic: pred = price * (1 + ((key * 7919) % 61 - 30) / 100).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hedonic.operators import correct as R
from hedonic.operators import evaluate as V
from hedonic.plans.catalog import query
from hedonic.session import table

_ERR_CTE = """
WITH r AS (SELECT DISTINCT o_orderkey AS _id, o_totalprice * 1.01::DOUBLE AS Lp,
                  o_totalprice * (1 + ((o_orderkey * 7919) % 61 - 30) / 100.0::DOUBLE) AS Pp, o_totalprice AS Sp
           FROM orders),
e AS (SELECT *, abs(Sp - Pp) / Sp AS diff_ratio FROM r WHERE _id IS NOT NULL AND Lp IS NOT NULL
      AND Pp IS NOT NULL AND Sp IS NOT NULL)
"""


def errors(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    r = o.select(F.col("o_orderkey").alias("_id"), (F.col("o_totalprice") * 1.01).alias("Lp"),
                 (F.col("o_totalprice") * (1 + (F.pmod(F.col("o_orderkey") * 7919, F.lit(61)) - 30) / 100.0))
                 .alias("Pp"), F.col("o_totalprice").alias("Sp"))
    return V.with_error(r)


@query("error_histogram", "A9 X8", _ERR_CTE + """,
b AS (SELECT CAST(ceil(diff_ratio * 100) AS BIGINT) AS b0, diff_ratio FROM e),
b1 AS (SELECT CASE WHEN diff_ratio <= (b0 - 1) / 100.0::DOUBLE THEN b0 - 1 ELSE b0 END AS b1, diff_ratio FROM b),
b2 AS (SELECT CASE WHEN diff_ratio > b1 / 100.0::DOUBLE THEN b1 + 1 ELSE b1 END AS percent FROM b1),
c AS (SELECT percent, count(*) AS cnt FROM b2 WHERE percent BETWEEN 1 AND 100 GROUP BY percent)
SELECT s.i AS percent, coalesce(c.cnt, 0) AS count,
       round(coalesce(c.cnt, 0) / (SELECT count(*) FROM e)::DOUBLE, 9) AS percentage
FROM range(1, 101) s(i) LEFT JOIN c ON c.percent = s.i""")
def error_histogram(spark, sf_dir):
    h = V.error_histogram(errors(spark, sf_dir))
    return h.select("percent", "count", F.round("percentage", 9).alias("percentage"))


@query("accuracy_summary", "A10", _ERR_CTE + """
SELECT count(*) AS n, round(median(diff_ratio), 9) AS median_error, round(avg(diff_ratio), 9) AS mean_error,
  round(avg(CASE WHEN diff_ratio < 0.03 THEN 1.0 ELSE 0.0 END), 9) AS within_3,
  round(median(CASE WHEN diff_ratio < 0.03 THEN diff_ratio END), 9) AS median_within_3,
  round(avg(CASE WHEN diff_ratio < 0.05 THEN 1.0 ELSE 0.0 END), 9) AS within_5,
  round(median(CASE WHEN diff_ratio < 0.05 THEN diff_ratio END), 9) AS median_within_5,
  round(avg(CASE WHEN diff_ratio < 0.10 THEN 1.0 ELSE 0.0 END), 9) AS within_10,
  round(median(CASE WHEN diff_ratio < 0.10 THEN diff_ratio END), 9) AS median_within_10,
  round(avg(CASE WHEN diff_ratio < 0.20 THEN 1.0 ELSE 0.0 END), 9) AS within_20,
  round(median(CASE WHEN diff_ratio < 0.20 THEN diff_ratio END), 9) AS median_within_20,
  round(avg(CASE WHEN diff_ratio > 0.2 THEN diff_ratio END), 9) AS mean_exceed,
  round(median(CASE WHEN diff_ratio > 0.2 THEN diff_ratio END), 9) AS median_exceed,
  round(max(CASE WHEN diff_ratio > 0.2 THEN diff_ratio END), 9) AS max_exceed
FROM e""")
def accuracy_summary(spark, sf_dir):
    s = V.accuracy_summary(errors(spark, sf_dir))
    return s.select(*[F.round(c, 9).alias(c) if c != "n" else F.col(c) for c in s.columns])


@query("accuracy_outliers", "A12", _ERR_CTE + """
SELECT _id, round(diff_ratio, 9) AS diff_ratio FROM e WHERE diff_ratio > 0.2""")
def accuracy_outliers(spark, sf_dir):
    return V.outliers(errors(spark, sf_dir)).select("_id", F.round("diff_ratio", 9).alias("diff_ratio"))


@query("run_comparison_hit_rate", "J5 A11 X8", """
WITH t AS (SELECT o_orderkey AS _id, o_totalprice AS Sp_dol FROM orders),
r1 AS (SELECT o_orderkey AS _id, o_totalprice * (1 + ((o_orderkey * 7919) % 61 - 30) / 1000.0::DOUBLE) AS origin_price FROM orders WHERE o_orderstatus <> 'P'),
r2 AS (SELECT o_orderkey AS _id, o_totalprice * (1 + ((o_orderkey * 104729) % 41 - 20) / 500.0::DOUBLE) AS pic_price FROM orders WHERE o_orderpriority <> '5-LOW'),
r3 AS (SELECT o_orderkey AS _id, o_totalprice * 1.04::DOUBLE AS feature_price FROM orders),
m AS (SELECT * FROM t JOIN r1 USING (_id) JOIN r2 USING (_id) JOIN r3 USING (_id)),
s AS (SELECT 'origin_price' AS run, abs(Sp_dol - origin_price) / Sp_dol AS d FROM m
      UNION ALL SELECT 'pic_price', abs(Sp_dol - pic_price) / Sp_dol FROM m
      UNION ALL SELECT 'feature_price', abs(Sp_dol - feature_price) / Sp_dol FROM m)
SELECT run, round(avg(CASE WHEN d <= 0.05 THEN 1.0 ELSE 0.0 END), 9) AS hit_5,
       round(avg(CASE WHEN d <= 0.03 THEN 1.0 ELSE 0.0 END), 9) AS hit_3 FROM s GROUP BY run""")
def run_comparison_hit_rate(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = o.select(F.col("o_orderkey").alias("_id"), F.col("o_totalprice").alias("Sp_dol"))
    r1 = o.where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("_id"),
        (F.col("o_totalprice") * (1 + (F.pmod(F.col("o_orderkey") * 7919, F.lit(61)) - 30) / 1000.0)).alias("origin_price"))
    r2 = o.where(F.col("o_orderpriority") != "5-LOW").select(
        F.col("o_orderkey").alias("_id"),
        (F.col("o_totalprice") * (1 + (F.pmod(F.col("o_orderkey") * 104729, F.lit(41)) - 20) / 500.0)).alias("pic_price"))
    r3 = o.select(F.col("o_orderkey").alias("_id"), (F.col("o_totalprice") * 1.04).alias("feature_price"))
    m = V.compare_runs([t, r1, r2, r3])
    h = V.hit_rate(m, "Sp_dol", ["origin_price", "pic_price", "feature_price"])
    return h.select("run", F.round("hit_5", 9).alias("hit_5"), F.round("hit_3", 9).alias("hit_3"))


_EMB_SQL = """
e AS (SELECT vec_id AS _id, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lng,
             CAST(embedding[3] AS DOUBLE) AS e3, CAST(embedding[4] AS DOUBLE) AS e4, CAST(embedding[5] AS DOUBLE) AS e5
      FROM embeddings),
nb AS (SELECT t._id, count(i._id) AS nearby FROM e t LEFT JOIN e i
       ON i.lat >= t.lat - 0.027::DOUBLE AND i.lat <= t.lat + 0.027::DOUBLE
      AND i.lng >= t.lng - 0.037::DOUBLE AND i.lng <= t.lng + 0.037::DOUBLE GROUP BY t._id)"""


@query("nearby_sold_count", "J4", "WITH " + _EMB_SQL.strip() + """
SELECT _id, nearby FROM nb""")
def nearby_sold_count(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return R.nearby_count(e, e)


@query("nearby_recent_sales", "J4 with the 200-day cut", """
WITH o AS (SELECT o_orderkey AS _id, 43 + (o_custkey % 97) * 0.01::DOUBLE AS lat, -79 + (o_orderkey % 89) * 0.01::DOUBLE AS lng,
                  CAST(o_orderdate AS DATE) AS d, o_orderstatus AS s FROM orders),
i AS (SELECT lat, lng FROM o WHERE s = 'F' AND d >= (SELECT max(d) FROM o WHERE s = 'F') - 200)
SELECT t._id, count(i.lat) AS nearby FROM (SELECT * FROM o WHERE s <> 'F') t LEFT JOIN i
       ON i.lat >= t.lat - 0.027::DOUBLE AND i.lat <= t.lat + 0.027::DOUBLE
      AND i.lng >= t.lng - 0.037::DOUBLE AND i.lng <= t.lng + 0.037::DOUBLE GROUP BY t._id""")
def nearby_recent_sales(spark, sf_dir):
    """Open listings against the sales of the 200 days before the last sale; every order is one or the other."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_id"), (F.lit(43) + F.pmod("o_custkey", F.lit(97)) * F.lit(0.01)).alias("lat"),
        (F.lit(-79) + F.pmod("o_orderkey", F.lit(89)) * F.lit(0.01)).alias("lng"), "o_orderdate", "o_orderstatus")
    sold = F.col("o_orderstatus") == "F"
    return R.nearby_count(o.where(~sold), o.where(sold), date_col="o_orderdate")


def _emb(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("_id"), F.col("embedding")[0].cast("double").alias("lat"),
                      F.col("embedding")[1].cast("double").alias("lng"),
                      F.col("embedding")[2].cast("double").alias("e3"), F.col("embedding")[3].cast("double").alias("e4"),
                      F.col("embedding")[4].cast("double").alias("e5"))


@query("listing_price_correction", "B3 X20 X8 J4", "WITH " + _EMB_SQL.strip() + """,
l AS (SELECT _id, 250000.0::DOUBLE + _id * 5000.0::DOUBLE AS lp,
             CASE WHEN _id % 10 = 0 THEN 0.0 ELSE (250000.0::DOUBLE + _id * 5000.0::DOUBLE) * (1 + e3) END AS gb,
             CASE WHEN _id % 10 = 0 THEN 0.0 ELSE (250000.0::DOUBLE + _id * 5000.0::DOUBLE) * (1 + e4) END AS ada,
             CASE WHEN _id % 10 = 0 THEN 0.0 ELSE (250000.0::DOUBLE + _id * 5000.0::DOUBLE) * (1 + e5) END AS rf
      FROM e),
d AS (SELECT l.*, abs(lp - gb) / lp AS dg, abs(lp - ada) / lp AS da, abs(lp - rf) / lp AS dr, nb.nearby
      FROM l JOIN nb USING (_id)),
n AS (SELECT *, least(dg, da, dr) AS dmin,
             CASE WHEN dr <= da AND dr <= dg THEN rf WHEN da <= dg THEN ada ELSE gb END AS nearest FROM d),
k AS (SELECT *, (dg + da + dr = 3 OR ((lp > 2000000 OR lp < 300000) AND dmin <= 1.24857::DOUBLE)
                 OR dmin <= 0.142857::DOUBLE OR nearby < 3) AS keep FROM n)
SELECT _id, round(CASE WHEN keep THEN lp ELSE nearest END, 4) AS Lp_dol, NOT keep AS lp_changed FROM k""")
def listing_price_correction(spark, sf_dir):
    e = _emb(spark, sf_dir)
    lp = F.lit(250000.0) + F.col("_id") * 5000.0
    missing = F.pmod("_id", F.lit(10)) == 0
    listings = e.select("_id", lp.alias("Lp_dol"),
                        *[F.when(missing, F.lit(0.0)).otherwise(lp * (1 + F.col(c))).alias(m)
                          for c, m in (("e3", "gb_pred"), ("e4", "ada_pred"), ("e5", "rf_pred"))])
    out = R.correct_prices(listings, R.nearby_count(e, e))
    return out.select("_id", F.round("Lp_dol", 4).alias("Lp_dol"), "lp_changed")


@query("period_cascade", "A2 X10 J11 F15", """
WITH p AS (SELECT p_partkey, replace(replace(p_name, '/', '_'), ' ', '_') AS Community,
                  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_size END AS Area_code,
                  DATE '2001-08-01' - CAST(p_partkey % 400 AS INT) AS Cd FROM part),
mx AS (SELECT max(Cd) AS m FROM p),
per AS (SELECT * FROM (VALUES ('2months', 60, 1), ('5months', 150, 2), ('1year', 360, 3)) v(period, days, priority)),
g AS (SELECT Community, period, priority, count(Area_code) AS cnt FROM p, mx, per
      WHERE Cd >= m - days GROUP BY Community, period, priority HAVING count(Area_code) >= 12 AND Community <> 'Other'),
best AS (SELECT Community, period FROM (SELECT *, row_number() OVER (PARTITION BY Community ORDER BY priority) AS r
         FROM g) WHERE r = 1)
SELECT s.s_suppkey AS _id, b.period
FROM supplier s LEFT JOIN best b ON b.Community = replace(replace(
  (SELECT p_name FROM part WHERE p_partkey = s.s_suppkey), '/', '_'), ' ', '_')""")
def period_cascade(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    rows = p.select("p_partkey", F.col("p_name").alias("Community"),
                    F.when(F.pmod("p_partkey", F.lit(6)) == 0, F.lit(None)).otherwise(F.col("p_size")).alias("Area_code"),
                    F.date_sub(F.lit("2001-08-01").cast("date"), F.pmod("p_partkey", F.lit(400)).cast("int")).alias("Cd"))
    groups = R.period_groups(rows, "Cd")
    s = table(spark, sf_dir, "supplier")
    listings = s.join(p, s["s_suppkey"] == p["p_partkey"], "left").select(
        F.col("s_suppkey").alias("_id"), F.col("p_name").alias("Community"))
    return R.pick_period(listings, groups).select("_id", "period")
