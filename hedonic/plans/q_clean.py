"""Cleaning operators on the test tables.

Nulls are planted with ``pmod(key, k) = 0`` where an operator needs some;
no row is filtered out by them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hedonic.functions import scalar as X
from hedonic.operators import clean as C
from hedonic.plans.catalog import query
from hedonic.session import table


def _null_when(key, k, value):
    return F.when(F.pmod(F.col(key), F.lit(k)) == 0, F.lit(None)).otherwise(value)


@query("clean_conditional_median_fill", "F4 F5 F6 A8 F10", """
WITH base AS (
  SELECT p_partkey, p_type,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size % 5 AS DOUBLE) END AS Taxes,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS Depth,
         CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS Front_ft,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS Bsmt1_out,
         CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS Dom
  FROM part),
f AS (SELECT * FROM base WHERE Taxes IS NULL OR Taxes <> 0),
m AS (SELECT median(Depth) AS dm, median(Front_ft) AS fm FROM f WHERE p_type NOT IN ('SMALL', 'ECONOMY'))
SELECT p_partkey, Taxes,
       coalesce(Depth, CASE WHEN p_type IN ('SMALL', 'ECONOMY') THEN 0.0 ELSE m.dm END) AS Depth,
       coalesce(Front_ft, CASE WHEN p_type IN ('SMALL', 'ECONOMY') THEN 0.0 ELSE m.fm END) AS Front_ft,
       coalesce(Bsmt1_out, 'None') AS Bsmt1_out, coalesce(Dom, 0.0) AS Dom
FROM f, m""")
def clean_conditional_median_fill(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    base = p.select("p_partkey", "p_type",
                    _null_when("p_partkey", 11, F.pmod("p_size", F.lit(5)).cast("double")).alias("Taxes"),
                    _null_when("p_partkey", 7, F.col("p_size").cast("double")).alias("Depth"),
                    _null_when("p_partkey", 5, F.col("p_retailprice")).alias("Front_ft"),
                    _null_when("p_partkey", 3, F.col("p_brand")).alias("Bsmt1_out"),
                    _null_when("p_partkey", 4, F.col("p_size").cast("double")).alias("Dom"))
    f = base.where(F.col("Taxes").isNull() | (F.col("Taxes") != 0))
    f = C.fill_constants(f, none_cols=["Bsmt1_out"], zero_cols=["Dom"], flag_col=None)
    filled, _ = C.fill_conditional_median(f, ["Depth", "Front_ft"], F.col("p_type").isin("SMALL", "ECONOMY"))
    return filled.select("p_partkey", "Taxes", "Depth", "Front_ft", "Bsmt1_out", "Dom")


@query("clean_rare_bucket", "F9 A5", """
WITH base AS (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_name END AS name FROM part),
keep AS (SELECT name FROM base WHERE name IS NOT NULL GROUP BY name HAVING count(*) > 32)
SELECT b.p_partkey, CASE WHEN k.name IS NOT NULL THEN b.name ELSE 'Other' END AS name
FROM base b LEFT JOIN keep k ON b.name = k.name""")
def clean_rare_bucket(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    base = p.select("p_partkey", _null_when("p_partkey", 13, F.col("p_name")).alias("name"))
    return C.bucket_rare(base, "name", min_count=32)


@query("clean_text_functions", "F8 X10 X11 X13 X14 X15 X16 X18", r"""
WITH b AS (
  SELECT c_custkey, c_name, c_mktsegment, c_nationkey,
         'Sold#' || CAST(20190101000000 + c_custkey * 7 AS VARCHAR) || '.csv' AS fname,
         'Listing#' || CAST(20180101000000 + c_custkey * 3 AS VARCHAR) || '_v2.csv' AS fname2,
         CASE WHEN c_custkey % 9 = 0 THEN 'n/a' ELSE CAST(c_custkey AS VARCHAR) || '.25' END AS tax_text
  FROM customer)
SELECT c_custkey,
       TRY_CAST(nullif(regexp_extract(c_name, '(\d+)', 1), '') AS DOUBLE) AS lead_num,
       translate(c_mktsegment || ' / ' || c_name, '/ ', '__') AS underscored,
       trim(regexp_replace('  ' || c_mktsegment || '   x  ', '\s+', ' ', 'g')) AS squished,
       split_part(c_mktsegment || ':' || CAST(c_nationkey AS VARCHAR) || ':' || CAST(c_custkey AS VARCHAR), ':', 1) AS key_head,
       substr(c_mktsegment || ':' || CAST(c_nationkey AS VARCHAR) || ':' || CAST(c_custkey AS VARCHAR),
              length(c_mktsegment) + 2) AS key_tail,
       CAST(list_max(list_transform(regexp_extract_all(fname2, '(\d+)', 1), lambda x: CAST(x AS HUGEINT))) AS VARCHAR) AS file_ts,
       substr(split_part(fname, '#', -1), 1, length(split_part(fname, '#', -1)) - 4) AS hash_ts,
       (CAST(substr(split_part(fname, '#', -1), 1, 4) AS INT) - CAST(substr(split_part(fname2, '#', -1), 1, 4) AS INT)) * 365
       + (CAST(substr(split_part(fname, '#', -1), 5, 2) AS INT) - CAST(substr(split_part(fname2, '#', -1), 5, 2) AS INT)) * 30
       + (CAST(substr(split_part(fname, '#', -1), 7, 2) AS INT) - CAST(substr(split_part(fname2, '#', -1), 7, 2) AS INT)) AS approx_days,
       TRY_CAST(tax_text AS DOUBLE) AS tax
FROM b""")
def clean_text_functions(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    b = c.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey",
                 F.concat(F.lit("Sold#"), (F.lit(20190101000000) + F.col("c_custkey") * 7).cast("string"),
                          F.lit(".csv")).alias("fname"),
                 F.concat(F.lit("Listing#"), (F.lit(20180101000000) + F.col("c_custkey") * 3).cast("string"),
                          F.lit("_v2.csv")).alias("fname2"),
                 F.when(F.pmod("c_custkey", F.lit(9)) == 0, F.lit("n/a"))
                  .otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit(".25"))).alias("tax_text"))
    key = F.concat_ws(":", "c_mktsegment", F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string"))
    hts = X.hash_timestamp("fname")
    hts2 = X.hash_timestamp("fname2")
    return b.select("c_custkey",
                    X.leading_number("c_name").alias("lead_num"),
                    X.underscore_names(F.concat_ws(" / ", "c_mktsegment", "c_name")).alias("underscored"),
                    X.squish(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("   x  "))).alias("squished"),
                    X.key_head(key).alias("key_head"), X.key_tail(key).alias("key_tail"),
                    X.file_timestamp("fname2").cast("string").alias("file_ts"),
                    hts.alias("hash_ts"),
                    X.approx_days(hts2, hts).alias("approx_days"),
                    X.try_double("tax_text").alias("tax"))


def _room_frame(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    aggs = []
    dims = []
    for k in range(1, 8):
        aggs.append(F.coalesce(F.max(F.when(F.col("l_linenumber") == k, F.col("l_quantity") * 2)),
                               F.lit(0.0)).alias(f"len{k}"))
        aggs.append(F.coalesce(F.max(F.when(F.col("l_linenumber") == k, F.col("l_discount") * 100)),
                               F.lit(0.0)).alias(f"wth{k}"))
        dims += [f"len{k}", f"wth{k}"]
    return li.groupBy("l_orderkey").agg(*aggs), dims


def _room_sql():
    cells = ",\n".join(
        f"coalesce(max(CASE WHEN l_linenumber = {k} THEN l_quantity * 2 END), 0.0) AS len{k}, "
        f"coalesce(max(CASE WHEN l_linenumber = {k} THEN l_discount * 100 END), 0.0) AS wth{k}"
        for k in range(1, 8))
    area = " + ".join(f"len{k} * wth{k}" for k in range(1, 8))
    nz = " + ".join(f"CAST(len{k} <> 0 AS INT) + CAST(wth{k} <> 0 AS INT)" for k in range(1, 8))
    return f"""
WITH w AS (SELECT l_orderkey, {cells} FROM lineitem GROUP BY l_orderkey),
a AS (SELECT l_orderkey, ({area}) AS area, ({nz}) / 2.0 AS rooms FROM w),
r AS (SELECT l_orderkey, CASE
        WHEN area / rooms > 1 AND area / rooms < 100 THEN area
        WHEN area / rooms >= 100 AND area / rooms < 700 THEN area / 10.7584::DOUBLE
        WHEN area / rooms >= 700 AND area / rooms < 8000 THEN area / 100.0::DOUBLE
        WHEN area / rooms >= 8000 AND area / rooms < 22500 THEN area / 1075.84::DOUBLE
        ELSE rooms * 25.0::DOUBLE END AS t FROM a WHERE rooms <> 0)
SELECT l_orderkey, round(t, 4) AS Rooms_total_area,
  CAST(t < 50 AS INT) AS "less-than50", CAST(t >= 50 AND t < 100 AS INT) AS "50-to-100",
  CAST(t >= 100 AND t < 150 AS INT) AS "100-to-150", CAST(t >= 150 AND t < 200 AS INT) AS "150-to-200",
  CAST(t >= 200 AND t < 250 AS INT) AS "200-to-250", CAST(t >= 250 AND t < 350 AS INT) AS "250-to-350",
  CAST(t >= 350 AS INT) AS "larger-than350"
FROM r"""


@query("room_area_buckets", "R1 R2 R3 R4", _room_sql())
def room_area_buckets(spark, sf_dir):
    wide, dims = _room_frame(spark, sf_dir)
    r = C.one_hot_ranges(C.room_area(wide, dims=dims), drop=False)
    return r.select("l_orderkey", F.round("Rooms_total_area", 4).alias("Rooms_total_area"),
                    *C.S.AREA_BUCKETS)


@query("month_flags_date_range", "R5 F14 X17", """
SELECT o_orderkey, """ + ", ".join(
    f"CAST(month(CAST(o_orderdate AS DATE)) = {i + 1} AS INT) AS {m}"
    for i, m in enumerate(["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"])) + """
FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-03-01' AND CAST(o_orderdate AS DATE) <= DATE '1998-06-30'""")
def month_flags_date_range(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    r = C.one_hot_month(C.date_range(o, "d", "1996-03-01", "1998-06-30"), "d")
    return r.select("o_orderkey", *C.S.MONTHS)


@query("trailing_windows", "F15 A7", """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders), mx AS (SELECT max(d) AS m FROM o)
SELECT (SELECT count(*) FROM o, mx WHERE d >= m - 60) AS n60,
       (SELECT count(*) FROM o, mx WHERE d >= m - 150) AS n150,
       (SELECT count(*) FROM o, mx WHERE d >= m - 200) AS n200,
       (SELECT count(*) FROM o, mx WHERE d >= m - 360) AS n360,
       CAST((SELECT min(d) FROM o) AS VARCHAR) AS min_date, CAST((SELECT max(d) FROM o) AS VARCHAR) AS max_date""")
def trailing_windows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    counts = [C.trailing(o, "d", n).agg(F.count(F.lit(1)).alias(f"n{n}")) for n in (60, 150, 200, 360)]
    out = o.agg(F.min("d").cast("string").alias("min_date"), F.max("d").cast("string").alias("max_date"))
    for c in counts:
        out = out.crossJoin(c)
    return out


@query("house_selection", "F2 F3 F7 F11 F12 F16 X19", """
SELECT p_partkey, p_size, p_retailprice, p_size + p_retailprice AS Garage, -p_retailprice AS lng,
       p_retailprice * 0.0315::DOUBLE AS std
FROM part
WHERE p_type IN ('STANDARD', 'MEDIUM', 'PROMO') AND p_brand <> 'Brand#1' AND p_size % 10 <> 0""")
def house_selection(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("kind_ok", F.lit("Sale")).withColumn("Gar", F.col("p_size")) \
        .withColumn("Gar_spaces", F.col("p_retailprice")).withColumn("lng", F.col("p_retailprice"))
    sel = C.select_kind(p, ["STANDARD", "MEDIUM", "PROMO"], ["p_partkey", "p_brand", "p_size", "p_retailprice",
                                                             "Gar", "Gar_spaces", "lng"],
                        type_col="p_type", sale_col="kind_ok")
    sel = sel.where(F.col("p_brand") != "Brand#1")
    sel = C.skip_zero(sel.withColumn("_m", F.pmod("p_size", F.lit(10))), "_m")
    d = C.derive_house(sel)
    d = d.withColumn("std", X.std_share("p_retailprice", 0.0315))
    return C.pick_columns(d, ["p_partkey", "p_size", "p_retailprice", "Garage", "lng", "std", "not_there"])


@query("condo_cleaning", "F13 F4", """
SELECT DISTINCT o_orderkey AS _id, o_totalprice AS Sp_dol, o_totalprice * 0.97::DOUBLE AS Lp_dol,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS Cd, o_orderpriority AS Addr
FROM orders
WHERE o_totalprice > 50000""")
def condo_cleaning(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cd = o.select(F.col("o_orderkey").alias("_id"), F.col("o_totalprice").alias("Sp_dol"),
                  (F.col("o_totalprice") * 0.97).alias("Lp_dol"), F.col("o_orderdate").alias("Cd"),
                  F.col("o_orderpriority").alias("Addr"))
    return C.clean_condos(cd, "Sold").withColumn("Cd", F.col("Cd").cast("string"))


@query("listing_plausibility", "F4", """
SELECT o_orderkey AS _id, o_totalprice AS Lp_dol, '2001-08-02' AS Cd
FROM orders
WHERE (CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_custkey % 3 AS DOUBLE) END IS NULL
       OR CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_custkey % 3 AS DOUBLE) END <> 0)
  AND o_totalprice > 50000""")
def listing_plausibility(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    df = o.select(F.col("o_orderkey").alias("_id"), F.col("o_totalprice").alias("Lp_dol"),
                  F.col("o_totalprice").alias("Sp_dol"), F.col("o_orderdate").alias("Cd"),
                  _null_when("o_orderkey", 17, F.pmod("o_custkey", F.lit(3)).cast("double")).alias("Taxes"))
    return (C.plausible_rows(df, "Listing", run_date="2001-08-02")
             .select("_id", "Lp_dol", F.col("Cd").cast("string").alias("Cd")))
