"""Encoder and price-transform queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hedonic.functions import encode as E
from hedonic.functions import scalar as X
from hedonic.plans.catalog import query
from hedonic.session import table

CUSTOMER_SPEC = E.EncoderSpec(binarize=["c_mktsegment", "sign"], scale=["c_acctbal"], minmax=["c_nationkey"],
                              passthrough=["odd"])


@query("encode_customer", "E1 E2 E3 E4 X9", """
WITH c AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 0 THEN 'pos' ELSE 'neg' END AS sign,
                  c_acctbal, c_nationkey, CAST(c_custkey % 2 AS INT) AS odd FROM customer),
s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd, min(c_nationkey) AS lo, max(c_nationkey) AS hi FROM c)
SELECT c_custkey,
  CAST(c_mktsegment = 'AUTOMOBILE' AS INT) AS c_mktsegment_AUTOMOBILE,
  CAST(c_mktsegment = 'BUILDING' AS INT) AS c_mktsegment_BUILDING,
  CAST(c_mktsegment = 'FURNITURE' AS INT) AS c_mktsegment_FURNITURE,
  CAST(c_mktsegment = 'HOUSEHOLD' AS INT) AS c_mktsegment_HOUSEHOLD,
  CAST(c_mktsegment = 'MACHINERY' AS INT) AS c_mktsegment_MACHINERY,
  CAST(sign = 'pos' AS INT) AS sign,
  round_even((c_acctbal - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE AS c_acctbal,
  round_even((c_nationkey - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE AS c_nationkey,
  odd
FROM c, s""")
def encode_customer(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") > 0, "pos").otherwise("neg").alias("sign"),
        "c_acctbal", "c_nationkey", F.pmod("c_custkey", F.lit(2)).cast("int").alias("odd"))
    model = E.fit_encoder(c, CUSTOMER_SPEC)
    return E.apply_encoder(c, CUSTOMER_SPEC, model, keep=["c_custkey"])


@query("price_transforms", "X1 X4 X5 X6 X7 X3", """
WITH o AS (SELECT o_orderkey, o_totalprice, o_orderstatus, ln(1 + o_totalprice) AS lg FROM orders),
b AS (SELECT min(lg) AS lo, max(lg) AS hi FROM o)
SELECT o_orderkey, round(lg, 9) AS log_price,
       round((lg - lo) / (hi - lo) * 100.0::DOUBLE, 6) AS scaled,
       trunc(exp((lg - lo) / (hi - lo) * 100.0::DOUBLE / 100.0::DOUBLE * (hi - lo) + lo + 0.0123::DOUBLE) - 1)::BIGINT AS back,
       coalesce(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE NULL END, -1) AS recoded,
       round(o_totalprice / exp(0.05::DOUBLE), 4) AS from_ratio
FROM o, b""")
def price_transforms(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("lg", X.log_price("o_totalprice"))
    b = o.agg(F.min("lg").alias("lo"), F.max("lg").alias("hi"))
    j = o.crossJoin(F.broadcast(b))
    scaled = X.scale_fixed("lg", F.col("lo"), F.col("hi"))
    return j.select("o_orderkey", F.round("lg", 9).alias("log_price"), F.round(scaled, 6).alias("scaled"),
                    X.expm1_trunc(X.unscale_fixed(scaled, F.col("lo"), F.col("hi")) + F.lit(0.0123)).alias("back"),
                    F.coalesce(X.recode("o_orderstatus", {"F": 1, "O": 0}), F.lit(-1)).alias("recoded"),
                    F.round(X.price_from_ratio("o_totalprice", F.lit(0.05)), 4).alias("from_ratio"))
