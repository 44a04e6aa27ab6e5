"""Condo queries on orders x customer x lineitem.

Mapping: Addr = c_mktsegment, Br = order-priority digit, Br_plus = o_custkey % 2,
Bath_tot = 1/2/3 by order status, Lp_dol = o_totalprice,
Sp_dol = o_totalprice * (0.8 + (o_orderkey % 61) / 100), Taxes = sum of line taxes,
Cd = o_orderdate.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hedonic.operators import condo as K
from hedonic.plans.catalog import query
from hedonic.session import table

TEST_RULES = {"HOUSEHOLD:1.0::2.0": 500000, "MACHINERY:3.0:1.0:2.0": 250000}

_BASE_SQL = """
WITH tax AS (SELECT l_orderkey, sum(l_tax * l_extendedprice) AS t FROM lineitem GROUP BY l_orderkey),
c AS (
  SELECT o.o_orderkey AS _id, cu.c_mktsegment AS Addr,
         CAST(CAST(substr(o.o_orderpriority, 1, 1) AS INT) AS DOUBLE) AS Br,
         CAST(o.o_custkey % 2 AS DOUBLE) AS Br_plus,
         CASE o.o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 2.0 ELSE 3.0 END AS Bath_tot,
         o.o_totalprice AS Lp_dol,
         o.o_totalprice * (0.8::DOUBLE + (o.o_orderkey % 61) / 100.0::DOUBLE) AS Sp_dol,
         tax.t AS Taxes, o.o_orderdate AS Cd
  FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey LEFT JOIN tax ON tax.l_orderkey = o.o_orderkey),
k AS (SELECT *, Addr || ':' || printf('%.1f', Br) || ':' || CASE WHEN Br_plus = 0 THEN '' ELSE printf('%.1f', Br_plus) END
               || ':' || printf('%.1f', Bath_tot) AS key FROM c),
recent AS (SELECT *, Sp_dol / Lp_dol AS ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY Cd DESC, _id DESC) AS rn FROM k) WHERE rn <= 5),
q AS (
  SELECT key, min(Lp_dol) AS lp_q0, quantile_cont(Lp_dol, 0.35) AS lp_q1, quantile_cont(Lp_dol, 0.5) AS lp_q2,
         quantile_cont(Lp_dol, 0.75) AS lp_q3, quantile_cont(Sp_dol, 0.3) AS sp_q1,
         CASE WHEN quantile_cont(ratio, 0.2) >= 1.0 THEN 0.95 ELSE quantile_cont(ratio, 0.2) END AS ratio_q1,
         CASE WHEN quantile_cont(ratio, 0.45) >= 1.3 THEN 1.05 ELSE quantile_cont(ratio, 0.45) END AS ratio_q2,
         coalesce(quantile_cont(CASE WHEN ratio > 0 THEN Taxes END, 0.35), 0.0) AS tax_q1, count(*) AS num
  FROM recent GROUP BY key)
"""


def condo_frame(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer")
    tax = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_tax") * F.col("l_extendedprice")).alias("Taxes"))
    c = (o.join(cu, o["o_custkey"] == cu["c_custkey"])
          .join(tax, o["o_orderkey"] == tax["l_orderkey"], "left")
          .select(F.col("o_orderkey").alias("_id"), F.col("c_mktsegment").alias("Addr"),
                  F.substring("o_orderpriority", 1, 1).cast("int").cast("double").alias("Br"),
                  F.pmod("o_custkey", F.lit(2)).cast("double").alias("Br_plus"),
                  F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "O", 2.0)
                   .otherwise(3.0).alias("Bath_tot"),
                  F.col("o_totalprice").alias("Lp_dol"),
                  (F.col("o_totalprice") * (F.lit(0.8) + F.pmod("o_orderkey", F.lit(61)) / F.lit(100.0)))
                  .alias("Sp_dol"),
                  "Taxes", F.col("o_orderdate").alias("Cd")))
    return K.with_unit_key(c)


def _round_q(df):
    cols = ["lp_q0", "lp_q1", "lp_q2", "lp_q3", "sp_q1", "ratio_q1", "ratio_q2", "tax_q1"]
    return df.select("key", *[F.round(c, 4).alias(c) for c in cols], "num")


@query("condo_quantiles", "A3 W4 X12 X18", _BASE_SQL + """
SELECT key, round(lp_q0, 4) AS lp_q0, round(lp_q1, 4) AS lp_q1, round(lp_q2, 4) AS lp_q2,
       round(lp_q3, 4) AS lp_q3, round(sp_q1, 4) AS sp_q1, round(ratio_q1, 4) AS ratio_q1,
       round(ratio_q2, 4) AS ratio_q2, round(tax_q1, 4) AS tax_q1, num FROM q""")
def condo_quantiles(spark, sf_dir):
    return _round_q(K.quantiles(condo_frame(spark, sf_dir)))


def _rules_sql(rules):
    return " UNION ALL ".join(f"SELECT '{k}' AS key, {float(v)}::DOUBLE AS rule_price" for k, v in rules.items())


@query("condo_price_rules", "B1 J9 J10 X19", _BASE_SQL + f""",
rules AS ({_rules_sql(TEST_RULES)}),
l AS (SELECT _id, key, Lp_dol * 1.02::DOUBLE AS Lp_dol, Taxes FROM k WHERE Bath_tot = 2.0),
j AS (SELECT l.*, r.rule_price, q.* EXCLUDE (key) FROM l LEFT JOIN rules r ON l.key = r.key LEFT JOIN q ON l.key = q.key),
s1 AS (SELECT *, CASE WHEN Lp_dol <= lp_q1 * 0.85::DOUBLE AND Lp_dol > lp_q0 AND tax_q1 <> 0
                      AND (Taxes >= tax_q1 * 0.9::DOUBLE OR Taxes = 0) THEN Lp_dol * 1.2::DOUBLE ELSE Lp_dol END AS lp1 FROM j),
s2 AS (SELECT *, CASE WHEN lp1 <= lp_q0 * 0.95::DOUBLE THEN lp1 * 1.1::DOUBLE ELSE lp1 END AS lp2 FROM s1),
s3 AS (SELECT *, CASE WHEN lp2 > lp_q3 * 1.1::DOUBLE THEN lp2 * ratio_q1 ELSE lp2 * ratio_q2 END AS pp0 FROM s2),
s4 AS (SELECT *, CASE WHEN pp0 / sp_q1 < 0.7::DOUBLE THEN sp_q1 * 0.8::DOUBLE ELSE pp0 END AS pp FROM s3),
f AS (SELECT _id,
        CASE WHEN rule_price IS NOT NULL THEN rule_price WHEN num >= 2 THEN pp ELSE Lp_dol * 0.98::DOUBLE END AS price,
        CASE WHEN rule_price IS NOT NULL THEN 'manual' WHEN num >= 2 THEN 'quantile' ELSE 'fallback' END AS route
      FROM s4)
SELECT _id, trunc(price)::BIGINT AS mean_price,
       round(price * CASE WHEN route = 'manual' THEN 0.03::DOUBLE ELSE 0.0315::DOUBLE END, 4) AS std, route FROM f""")
def condo_price_rules(spark, sf_dir):
    base = condo_frame(spark, sf_dir)
    q = K.quantiles(base)
    listings = base.where(F.col("Bath_tot") == 2.0).select("_id", "key", (F.col("Lp_dol") * 1.02).alias("Lp_dol"),
                                                           "Taxes")
    r = K.predict(listings, q, K.rules_frame(spark, TEST_RULES))
    return r.select("_id", "mean_price", F.round("std", 4).alias("std"), "route")


def supplier_brand_frame(spark, sf_dir):
    """Address = supplier, unit type = part brand, price = unit price of a line."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    return (li.join(p, li["l_partkey"] == p["p_partkey"])
              .select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("addr"),
                      F.col("p_brand").alias("ctype"), F.lit(1.0).alias("Br"),
                      (F.col("l_extendedprice") / F.col("l_quantity")).alias("Sp_dol"),
                      F.col("l_quantity").alias("qty"), F.col("l_discount").alias("disc"),
                      F.col("p_retailprice").alias("retail")))


@query("condo_price_matrix", "A4 A5 A6 F16", """
WITH r AS (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS addr, p_brand AS ctype, l_extendedprice / l_quantity AS p
           FROM lineitem JOIN part ON l_partkey = p_partkey),
types AS (SELECT ctype FROM r GROUP BY ctype HAVING count(*) > 30)
SELECT addr, ctype, trunc(median(p))::BIGINT AS price FROM r WHERE ctype IN (SELECT ctype FROM types)
GROUP BY addr, ctype""")
def condo_price_matrix(spark, sf_dir):
    return K.price_matrix(supplier_brand_frame(spark, sf_dir)).select("addr", "ctype", "price")


@query("condo_price_matrix_dense", "A6", """
WITH r AS (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS addr, p_brand AS ctype, l_extendedprice / l_quantity AS p
           FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT addr, ctype, trunc(median(p))::BIGINT AS price FROM r GROUP BY addr, ctype),
d AS (SELECT a.addr, t.ctype, coalesce(m.price, 0) AS price
      FROM (SELECT DISTINCT addr FROM m) a CROSS JOIN (SELECT DISTINCT ctype FROM m) t
      LEFT JOIN m ON m.addr = a.addr AND m.ctype = t.ctype)
SELECT addr, count(*) AS n_cells, sum(CAST(price = 0 AS INT)) AS n_zero, sum(price) AS total FROM d GROUP BY addr""")
def condo_price_matrix_dense(spark, sf_dir):
    m = K.price_matrix(supplier_brand_frame(spark, sf_dir), min_type_count=0)
    d = K.dense_matrix(m)
    types = [c for c in d.columns if c != "addr"]
    import functools
    import operator
    return d.select("addr", F.lit(len(types)).cast("long").alias("n_cells"),
                    functools.reduce(operator.add, [(F.col(f"`{t}`") == 0).cast("long") for t in types]).alias("n_zero"),
                    functools.reduce(operator.add, [F.col(f"`{t}`") for t in types]).alias("total"))
