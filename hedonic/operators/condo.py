"""Condo unit keys, per-key quantiles, price matrix and the rule cascade
(X11-X13, X18, A3-A6, W4, F16, J9, J10, B1, X19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hedonic import schemas as S
from hedonic.functions.scalar import squish, try_double, unit_key

CONDO_STD_SHARE = 0.0315   # fixed value
MANUAL_STD_SHARE = 0.03    # fixed value
FALLBACK_FACTOR = 0.98     # fixed value
QUANTILE_ROWS = 5          # fixed value: most recent rows per key
MIN_TYPE_COUNT = 30        # fixed value: unit types with more rows enter the matrix


def with_unit_key(df: DataFrame, addr="Addr", br="Br", br_plus="Br_plus", bath="Bath_tot",
                  clean_addr: bool = False) -> DataFrame:
    """Add ``key`` = addr:br:br_plus:bath and ``ctype`` = br:br_plus:bath."""
    a = squish(addr) if clean_addr else F.col(addr)
    k = unit_key(a, br, br_plus, bath)
    return df.withColumn("key", k).withColumn("ctype", F.split(k, ":", 2).getItem(1)) \
             .withColumn("addr", F.substring_index(k, ":", 1))


def quantiles(sold: DataFrame, date_col: str = "Cd", tie_col: str = "_id", n: int = QUANTILE_ROWS) -> DataFrame:
    """Per-key quantile table over the ``n`` most recent rows.

    Columns: key, lp_q0 (min), lp_q1 (.35), lp_q2 (.5), lp_q3 (.75),
    sp_q1 (.3), ratio_q1 (.2, capped), ratio_q2 (.45, capped),
    tax_q1 (.35 over rows with ratio > 0; 0 when none), num.
    Exact linear-interpolated percentiles; ``row_number <= n`` is cut
    per key before the shuffle (WindowGroupLimit).
    """
    w = Window.partitionBy("key").orderBy(F.col(date_col).desc(), F.col(tie_col).desc())
    recent = (sold.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
                  .withColumn("ratio", F.col("Sp_dol").cast("double") / F.col("Lp_dol").cast("double")))
    lp = F.col("Lp_dol").cast("double")
    agg = recent.groupBy("key").agg(
        F.min(lp).alias("lp_q0"),
        F.percentile(lp, [0.35, 0.5, 0.75]).alias("_lpq"),
        F.percentile(F.col("Sp_dol").cast("double"), 0.3).alias("sp_q1"),
        F.percentile("ratio", [0.2, 0.45]).alias("_rq"),
        F.percentile(F.when(F.col("ratio") > 0, try_double("Taxes")), 0.35).alias("_tq"),
        F.count(F.lit(1)).alias("num"))
    r1, r2 = F.col("_rq")[0], F.col("_rq")[1]
    return agg.select(
        "key", "lp_q0", F.col("_lpq")[0].alias("lp_q1"), F.col("_lpq")[1].alias("lp_q2"),
        F.col("_lpq")[2].alias("lp_q3"), "sp_q1",
        F.when(r1 >= 1.0, F.lit(0.95)).otherwise(r1).alias("ratio_q1"),
        F.when(r2 >= 1.3, F.lit(1.05)).otherwise(r2).alias("ratio_q2"),
        F.coalesce(F.col("_tq"), F.lit(0.0)).alias("tax_q1"), "num")


def price_matrix(sold: DataFrame, price_col: str = "Sp_dol", min_type_count: int = MIN_TYPE_COUNT) -> DataFrame:
    """Long-form address x unit-type matrix of median prices.

    Rows with 0 bedrooms are skipped; unit types with more than
    ``min_type_count`` rows enter; cell = median price truncated to int.
    Absent cells are the zeros of the dense matrix (not stored).
    """
    rows = sold.where(F.col("Br").cast("double") != 0)
    types = rows.groupBy("ctype").count().where(F.col("count") > min_type_count).select("ctype")
    med = rows.groupBy("addr", "ctype").agg(F.median(F.col(price_col).cast("double")).cast("long").alias("price"))
    return med.join(types, "ctype", "left_semi")


def dense_matrix(matrix: DataFrame) -> DataFrame:
    """Pivot to one column per unit type, missing -> 0."""
    return matrix.groupBy("addr").pivot("ctype").agg(F.first("price")).fillna(0)


def rules_frame(spark: SparkSession, rules: dict | None = None) -> DataFrame:
    rules = S.MANUAL_RULES if rules is None else rules
    return spark.createDataFrame([(k, float(v)) for k, v in rules.items()], "key string, rule_price double")


def predict(listings: DataFrame, qtable: DataFrame, rules: DataFrame) -> DataFrame:
    """Condo price rule cascade (B1 with J9 lookup and J10 manual rules).

    (1) manual rule price; (2) quantile row with num >= 2: +20 % when lp is
    low vs q1 but above q0 and the tax is in line, +10 % when lp <= .95 q0,
    price = lp * ratio_q1 above 1.1 q3 else lp * ratio_q2, floored at
    .8 sp_q1 when below .7 sp_q1; (3) else lp * .98.
    Output: _id, mean_price (truncated), std.
    The lookup tables are joined by key; AQE broadcasts them when small.
    """
    j = listings.join(rules, "key", "left").join(qtable, "key", "left")
    lp = F.col("Lp_dol").cast("double")
    tax = try_double("Taxes")
    bump = ((lp <= F.col("lp_q1") * 0.85) & (lp > F.col("lp_q0")) & (F.col("tax_q1") != 0)
            & ((tax >= F.col("tax_q1") * 0.9) | (tax == 0)))
    lp1 = F.when(F.coalesce(bump, F.lit(False)), lp * 1.2).otherwise(lp)
    lp2 = F.when(lp1 <= F.col("lp_q0") * 0.95, lp1 * 1.1).otherwise(lp1)
    pp = F.when(lp2 > F.col("lp_q3") * 1.1, lp2 * F.col("ratio_q1")).otherwise(lp2 * F.col("ratio_q2"))
    pp = F.when(pp / F.col("sp_q1") < 0.7, F.col("sp_q1") * 0.8).otherwise(pp)
    has_q = F.col("num").isNotNull() & (F.col("num") >= 2)
    price = (F.when(F.col("rule_price").isNotNull(), F.col("rule_price"))
              .when(has_q, pp).otherwise(lp * FALLBACK_FACTOR))
    share = F.when(F.col("rule_price").isNotNull(), F.lit(MANUAL_STD_SHARE)).otherwise(F.lit(CONDO_STD_SHARE))
    return j.select("_id", price.cast("long").alias("mean_price"), (price * share).alias("std"),
                    F.when(F.col("rule_price").isNotNull(), "manual").when(has_q, "quantile")
                     .otherwise("fallback").alias("route"))
