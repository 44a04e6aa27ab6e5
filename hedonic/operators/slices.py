"""Time slices, partition ranges, dedup, splits and set operations
(R7, R8, S6, S7, J15, W2-W4, W7-W9, U1-U5).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hedonic.functions.scalar import seeded_hash
from hedonic.operators.sampling import exact_hash_flag
from hedonic.session import bounded_broadcast

SLICE_ANCHOR = "2000-01-01"  # fixed value: first slice start anchor
MAX_CALENDAR_DAYS = 366 * 200  # size bound of any one-row-per-day table


def day_to_slice(df: DataFrame, date_col: str, interval: int = 20, anchor: str = SLICE_ANCHOR,
                 floor: str | None = None) -> DataFrame:
    """Map every distinct day of ``date_col`` to its slice number.

    Greedy slicing in date order: a slice opens on the first day that is at
    least ``interval`` days after the current slice's start (the first start
    is measured from ``anchor``); days before the first opened start form
    slice 1. The fold is sequential by nature, so it runs over the distinct
    *days* only -- one row per calendar day, a size bounded by the calendar
    (not by the data) -- carrying only the short array of starts. The result
    (day, slice_id) is as small and is broadcast to the rows.
    """
    d = df.select(F.col(date_col).cast("date").alias("day")).where(F.col("day").isNotNull())
    if floor is not None:
        d = d.where(F.col("day") >= F.lit(floor).cast("date"))
    days = d.distinct().agg(F.sort_array(F.collect_list("day")).alias("ds"))
    start0 = F.array(F.lit(anchor).cast("date"))
    starts = F.aggregate(
        "ds", start0,
        lambda acc, x: F.when(F.datediff(x, F.element_at(acc, -1)) >= interval,
                              F.concat(acc, F.array(x))).otherwise(acc))
    s = days.select("ds", starts.alias("starts")).select(  # all but the anchor
        "ds", F.slice("starts", 2, F.greatest(F.size("starts") - 1, F.lit(0))).alias("starts"))
    # slice = number of starts on or before the day, +1 when days precede the first start
    pre = F.when((F.size("starts") == 0) | (F.element_at("ds", 1) < F.element_at("starts", 1)), 1).otherwise(0)
    mapped = s.select(F.explode(F.transform(
        "ds", lambda x: F.struct(x.alias("day"),
                                 (F.size(F.filter("starts", lambda st: st <= x)) + pre).alias("slice_id"))))
        .alias("m"))
    return mapped.select("m.day", "m.slice_id")


def assign_slices(df: DataFrame, date_col: str, interval: int = 20, anchor: str = SLICE_ANCHOR,
                  floor: str | None = None) -> DataFrame:
    """Rows with their ``slice_id`` (R7): equi-join on the day with the
    broadcast day->slice map (bounded by calendar days)."""
    m = bounded_broadcast(day_to_slice(df, date_col, interval, anchor, floor), MAX_CALENDAR_DAYS)
    rows = df.withColumn("_day", F.col(date_col).cast("date"))
    if floor is not None:
        rows = rows.where(F.col("_day") >= F.lit(floor).cast("date"))
    return rows.join(m, rows["_day"] == m["day"]).drop("_day", "day")


def slice_stats(sliced: DataFrame, date_col: str) -> DataFrame:
    """Rows, first and last date per slice."""
    return sliced.groupBy("slice_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                          F.min(F.col(date_col).cast("date")).alias("first_day"),
                                          F.max(F.col(date_col).cast("date")).alias("last_day"))


def max_partition(df: DataFrame, col: str = "slice_id") -> DataFrame:
    """Highest partition number, -1 when there is none; names that are no number are skipped."""
    return df.agg(F.coalesce(F.max(F.col(col).try_cast("int")), F.lit(-1)).alias("max_slice"))


def slice_range(df: DataFrame, lo: Column | int, hi: Column | int, col: str = "slice_id") -> DataFrame:
    """Rows of partitions lo..hi inclusive (S6); on a ``partitionBy`` table the
    literal bounds prune whole partitions."""
    return df.where(F.col(col).between(lo, hi))


def neighbour_slices(df: DataFrame, s: int, col: str = "slice_id") -> DataFrame:
    """Slices s-2..s+2 (S6, pair training window)."""
    return slice_range(df, s - 2, s + 2, col)


def last_slices(df: DataFrame, n: int = 9, col: str = "slice_id") -> DataFrame:
    """The last ``n`` slices: max-n+1..max, starting at 1 when max < n."""
    mx = bounded_broadcast(max_partition(df, col), 1)
    lo = F.greatest(F.col("max_slice") - F.lit(n - 1), F.lit(1))
    return df.crossJoin(mx).where(F.col(col).between(lo, F.col("max_slice"))).drop("max_slice")


def unpaired_slices(slices: DataFrame, paired: DataFrame, widen: int = 2, col: str = "slice_id") -> DataFrame:
    """Slice numbers whose pairs must be (re)built (J15): every slice after the
    last paired one, widened by ``widen`` earlier slices that gain right
    neighbours. Fails when more slices are paired than exist."""
    s_ids = slices.select(F.col(col).cast("int").alias(col)).distinct()
    mx_pair = paired.agg(F.coalesce(F.max(F.col(col).cast("int")), F.lit(0)).alias("_mp"))
    mx_slice = s_ids.agg(F.coalesce(F.max(col), F.lit(0)).alias("_ms"))
    bounds = bounded_broadcast(mx_pair.crossJoin(mx_slice), 1).select(
        "*", F.when(F.col("_mp") > F.col("_ms"),
                    F.raise_error(F.lit("more paired slices than slices"))).alias("_chk"))
    todo = s_ids.crossJoin(bounds).where(
        (F.col(col) >= F.greatest(F.col("_mp") + 1 - widen, F.lit(1))) & (F.col(col) <= F.col("_ms")))
    return todo.select(col)


def dedup_latest(df: DataFrame, key: str, date_col: str, tie_col: str | None = None) -> DataFrame:
    """Keep the latest row per key (W2); ``tie_col`` breaks equal dates (largest wins)."""
    order = [F.col(date_col).desc_nulls_last()]
    if tie_col:
        order.append(F.col(tie_col).desc_nulls_last())
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_n_per_key(df: DataFrame, key, order: list[Column], n: int = 5) -> DataFrame:
    """First ``n`` rows of every key in the given order.

    ``row_number() <= n`` with a literal n: Spark plans a WindowGroupLimit
    that cuts every key to n rows *before* the shuffle, so hot keys cost n
    rows per map task.
    """
    keys = key if isinstance(key, list) else [key]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def split_by_time(df: DataFrame, date_col: str, id_col: str, fraction: float = 0.1,
                  seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Chronological split (W8): (older rows, the last int(fraction*n) rows).

    Order is (day, then a seeded hash of the id) -- the source's sort leaves
    ties on a day undefined. Instead of a global row_number in one task:
    daily counts (one row per calendar day) give the boundary day and how
    many of its rows belong to the tail; inside the boundary day the rows are
    picked with the bucketed exact hash sample.
    """
    rows = df.withColumn("_day", F.col(date_col).cast("date"))
    daily = rows.groupBy("_day").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, 0)
    total = daily.agg(F.sum("_c").alias("_n"))
    plan = (daily.crossJoin(total)
                 .withColumn("_k", F.floor(F.col("_n") * F.lit(fraction)).cast("long"))
                 .withColumn("_cum", F.sum("_c").over(w))
                 .withColumn("_before", F.col("_cum") - F.col("_c"))
                 .select("_day", F.when(F.col("_cum") <= F.col("_k"), F.lit(-1))
                                  .when(F.col("_before") < F.col("_k"), F.col("_k") - F.col("_before"))
                                  .otherwise(F.lit(0)).cast("long").alias("_take")))
    plan = bounded_broadcast(plan, MAX_CALENDAR_DAYS)
    j = rows.join(plan, "_day", "left").withColumn("_take", F.coalesce("_take", F.lit(0)))  # no day: among the older
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))
    edge = exact_hash_flag(j.where(F.col("_take") > 0), ["_day"], key, F.col("_take"))
    # every row is on one side, whatever ids repeat: the sides are filters over rows, not matches of ids
    tail = j.where(F.col("_take") == -1).unionByName(edge.where("_in").drop("_in"))
    head = j.where(F.col("_take") == 0).unionByName(edge.where("NOT _in").drop("_in"))
    return head.drop("_day", "_take"), tail.drop("_day", "_take")


def split_by_hash(df: DataFrame, id_col: str, train_pct: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Stable random split (W9): pmod(hash(id, seed), 100) < train_pct -> train."""
    b = F.pmod(seeded_hash(id_col, seed), F.lit(100))
    return df.where(b < train_pct), df.where(b >= train_pct)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union all, columns matched by name, missing ones null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_of_distincts(a: DataFrame, b: DataFrame) -> DataFrame:
    """distinct(a) union-all distinct(b): duplicates across the two stay."""
    return a.distinct().unionByName(b.distinct(), allowMissingColumns=True)


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    """Union then whole-row distinct."""
    return union_all(frames).distinct()


def id_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set union of ids (U4)."""
    return a.union(b).distinct()


def id_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set intersection of ids (U4)."""
    return a.intersect(b)


def id_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set difference."""
    return a.subtract(b)
