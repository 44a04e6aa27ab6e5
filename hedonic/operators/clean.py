"""Validation, row selection, null filling and derived columns.

Every operator is a DataFrame -> DataFrame function built from built-in
expressions; fitted state (medians, kept communities) is a one-row or
small lookup DataFrame joined back, never a driver-side value, so the same
plan works in batch and inside a stream's ``foreachBatch``.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic import schemas as S
from hedonic.functions.exact import exact_medians
from hedonic.functions.scalar import leading_number


def missing_columns(columns: list[str], required: list[str] | None = None) -> list[str]:
    """Required columns absent from ``columns`` (F1)."""
    need = required or (S.HOUSE_COLUMNS + [c for c in S.CONDO_COLUMNS if c not in S.HOUSE_COLUMNS])
    have = set(columns)
    return [c for c in need if c not in have]


def check_columns(df: DataFrame, required: list[str] | None = None) -> bool:
    """File gate: at least one row and every required column present (F1)."""
    return not missing_columns(df.columns, required) and not df.isEmpty()


def select_kind(df: DataFrame, labels: list[str], columns: list[str], type_col: str = "Type_own1_out",
                sale_col: str = "S_r", sale: str = "Sale", status_col: str | None = None,
                status: str = "Sld") -> DataFrame:
    """Label filter + sale filter (+ status filter) + projection."""
    cond = F.col(type_col).isin(labels) & (F.col(sale_col) == sale)
    if status_col:
        cond = cond & (F.col(status_col) == status)
    return df.where(cond).select(*columns)


def plausible_rows(df: DataFrame, kind: str, run_date=None, tax_col: str = "Taxes",
                   date_col: str = "Cd", sold_col: str = "Sp_dol", list_col: str = "Lp_dol",
                   min_price: float = S.MIN_PRICE) -> DataFrame:
    """Row plausibility by kind.

    All: taxes != 0 (a null tax passes). Sold: date present and sold price >
    min_price. Listing: list price > min_price, sold price dropped, date set
    to ``run_date`` (a parameter, the run's date).
    """
    df = df.where(F.col(tax_col).isNull() | (F.col(tax_col) != 0))
    if kind == "Sold":
        return df.where(F.col(date_col).isNotNull() & (F.col(sold_col) > min_price))
    if kind == "Listing":
        df = df.where(F.col(list_col) > min_price).drop(sold_col)
        return df.withColumn(date_col, F.lit(run_date).cast("date") if run_date is not None
                             else F.current_date())
    raise ValueError(f"unknown kind {kind}")


def fill_constants(df: DataFrame, none_cols=None, zero_cols=None, flag_col: str | None = "Den_fr") -> DataFrame:
    """Constant null fill: text columns -> 'None', numeric -> 0, flag -> 'N' (F5)."""
    none_cols = [c for c in (S.FILL_NONE_COLUMNS if none_cols is None else none_cols) if c in df.columns]
    zero_cols = [c for c in (S.FILL_ZERO_COLUMNS if zero_cols is None else zero_cols) if c in df.columns]
    fills = {c: "None" for c in none_cols}
    df = df.fillna(fills) if fills else df
    df = df.fillna(0, subset=zero_cols) if zero_cols else df
    if flag_col and flag_col in df.columns:
        df = df.fillna({flag_col: "N"})
    return df


def fit_medians(df: DataFrame, cols: list[str], zero_rows: Column) -> DataFrame:
    """Exact medians of ``cols`` over the rows that are not ``zero_rows`` (A8),
    by distributed selection -> a one-row DataFrame (the fitted state)."""
    rest = df.where(~F.coalesce(zero_rows, F.lit(False)))
    medians = exact_medians(rest, {f"{c}_median": F.col(c) for c in cols})
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(n) for n, v in medians.items()])


def fill_conditional_median(df: DataFrame, cols: list[str], zero_rows: Column,
                            medians: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Conditional fill (F6): nulls of ``zero_rows`` rows -> 0, other nulls ->
    the median of the other rows (or the given saved medians; fitted only when
    there are none or every saved median is 0). Returns (filled rows, medians used).

    The medians are a one-row table joined with a broadcast (size 1).
    """
    use = medians
    if medians is not None:
        saved = medians.select(*[f"{c}_median" for c in cols]).first()    # one row
        use = None if saved is None or all(v == 0 for v in saved) else medians
    if use is None:
        use = fit_medians(df, cols, zero_rows)
    out = df.crossJoin(F.broadcast(use))
    for c in cols:
        fill = F.when(F.coalesce(zero_rows, F.lit(False)), F.lit(0.0)).otherwise(F.col(f"{c}_median"))
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), fill))
    return out.drop(*[f"{c}_median" for c in cols]), use


def derive_house(df: DataFrame) -> DataFrame:
    """Garage = Gar + Gar_spaces, lng sign flip, inputs dropped."""
    return (df.withColumn("Garage", F.col("Gar") + F.col("Gar_spaces"))
              .drop("Gar", "Gar_spaces")
              .withColumn("lng", -F.col("lng")))


def fit_rare_buckets(df: DataFrame, col: str, min_count: int = S.COMMUNITY_MIN_COUNT) -> DataFrame:
    """Values seen more than ``min_count`` times (A5); the fitted keep-list."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).count()
              .where(F.col("count") > min_count).select(F.col(col).alias("_keep")))


def bucket_rare(df: DataFrame, col: str, keep: DataFrame | None = None,
                min_count: int = S.COMMUNITY_MIN_COUNT, other: str = S.OTHER) -> DataFrame:
    """Rare-category bucketing (F9): values outside the keep-list (or null) ->
    ``other``. The keep-list is fitted (A5) when not given. It is joined
    with a left join; Catalyst/AQE broadcast it when it is small.
    """
    keep = fit_rare_buckets(df, col, min_count) if keep is None else keep
    j = df.join(keep, F.col(col) == F.col("_keep"), "left")
    return j.withColumn(col, F.when(F.col("_keep").isNotNull(), F.col(col)).otherwise(F.lit(other))).drop("_keep")


def process_columns(df: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """Area code digits, garage, longitude, community buckets."""
    df = df.withColumn("Area_code", leading_number("Area_code"))
    return bucket_rare(derive_house(df), "Community", keep)


def one_hot_month(df: DataFrame, date_col: str = "Cd", names: list[str] = S.MONTHS) -> DataFrame:
    """12 month flags."""
    m = F.month(F.col(date_col).cast("date"))
    return df.select("*", *[(m == i + 1).cast("int").alias(n) for i, n in enumerate(names)])


def room_area(df: DataFrame, dims: list[str] = S.ROOM_DIMS, out: str = "Rooms_total_area",
              fill: float | None = None) -> DataFrame:
    """Total room area with unit inference (R1-R3); rows without rooms dropped; null cells are ``fill`` if given.

    R1 sum of length x width over 12 rooms; R2 rooms = non-zero cells / 2;
    R3 piecewise unit conversion of the mean room area a:
    1 < a < 100 as is; [100, 700) / 10.7584; [700, 8000) / 100;
    [8000, 22500) / 1075.84; otherwise rooms x 25.
    """
    cell = {c: F.col(c) if fill is None else F.coalesce(F.col(c), F.lit(fill)) for c in dims}
    lens, wths = dims[0::2], dims[1::2]
    area = functools.reduce(operator.add, [cell[l] * cell[w] for l, w in zip(lens, wths)])
    # a null cell counts as non-zero, as a NaN does in the source rule
    nonzero = functools.reduce(operator.add, [F.coalesce(cell[c] != 0, F.lit(True)).cast("int")
                                              for c in dims])
    df = df.withColumn("_area", area).withColumn("_rooms", nonzero / F.lit(2.0)).where(F.col("_rooms") != 0)
    a = F.try_divide(F.col("_area"), F.col("_rooms"))     # may be computed before the filter above
    conv = (F.when((a > 1) & (a < 100), F.col("_area"))
             .when((a >= 100) & (a < 700), F.col("_area") / F.lit(10.7584))
             .when((a >= 700) & (a < 8000), F.col("_area") / F.lit(100.0))
             .when((a >= 8000) & (a < 22500), F.col("_area") / F.lit(1075.84))
             .otherwise(F.col("_rooms") * F.lit(25.0)))
    return df.withColumn(out, conv).drop("_area", "_rooms")


def one_hot_ranges(df: DataFrame, col: str = "Rooms_total_area", names: list[str] = S.AREA_BUCKETS,
                   edges: list[float] = S.AREA_EDGES, drop: bool = True) -> DataFrame:
    """Seven-way bucket one-hot (R4): < e0, [e0,e1), ..., >= e5 (null -> last)."""
    v = F.col(col)
    flags = [(v < edges[0])]
    for lo, hi in zip(edges[:-1], edges[1:]):
        flags.append((v >= lo) & (v < hi))
    first = functools.reduce(operator.or_, flags)
    flags.append(~F.coalesce(first, F.lit(False)))
    out = df.select("*", *[F.coalesce(f, F.lit(False)).cast("int").alias(n) for f, n in zip(flags, names)])
    return out.drop(col) if drop else out


def drop_incomplete(df: DataFrame, drop_cols=("Lsc", "S_r"), distinct: bool = True,
                    unchecked=()) -> DataFrame:
    """Drop status columns, rows with any null (but in ``unchecked``), and (``distinct``) duplicate rows."""
    df = df.drop(*[c for c in drop_cols if c in df.columns])
    # a condition a column: one over all columns is copied by the optimizer for each renamed column it holds
    for f in df.schema.fields:
        if f.name in unchecked:
            continue
        df = df.where(F.col(f"`{f.name}`").isNotNull())
        if f.dataType.typeName() in ("double", "float"):
            df = df.where(~F.isnan(f"`{f.name}`"))
    return df.distinct() if distinct else df


def pick_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Fixed-list selection in the given order, skipping absent ones."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def clean_condos(df: DataFrame, kind: str, date_col: str = "Cd", min_price: float = S.MIN_PRICE) -> DataFrame:
    """Condo cleaning (F13): parse date, whole-row distinct, price rules."""
    df = df.withColumn(date_col, F.to_date(F.col(date_col))).distinct()
    if kind == "Sold":
        return df.where(F.col("Sp_dol").isNotNull() & (F.col("Sp_dol") > min_price))
    if kind == "Listing":
        return df.where(F.col("Lp_dol") > min_price).drop("Sp_dol")
    raise ValueError(kind)


def date_range(df: DataFrame, col: str, start=None, end=None) -> DataFrame:
    """Inclusive date range, both ends optional (F14); pushed to the scan."""
    c = F.col(col)
    if start is not None:
        df = df.where(c >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(c <= F.lit(end).cast("date"))
    return df


def trailing(df: DataFrame, col: str, days: int) -> DataFrame:
    """Rows within ``days`` of the data's own latest date.

    The latest date is a one-row aggregate, joined with a broadcast (size 1).
    """
    latest = df.agg(F.max(F.col(col).cast("date")).alias("_latest"))
    return (df.crossJoin(F.broadcast(latest))
              .where(F.col(col).cast("date") >= F.date_sub(F.col("_latest"), days))
              .drop("_latest"))


def skip_zero(df: DataFrame, col: str = "Br") -> DataFrame:
    """Skip rows whose value is 0 (F16)."""
    return df.where(F.col(col).cast("double") != 0)


def clean_houses(df: DataFrame, kind: str = "Sold", medians: DataFrame | None = None,
                 communities: DataFrame | None = None, run_date=None):
    """House cleaning pipeline (T6 full rebuild when no state is given, T5
    incremental with saved medians/communities). Returns
    (clean rows, medians, community keep-list).

    Pass rows as they are read from files or written tables: the optimizer copies the condition on the 24 room
    cells once for each of them that is a renamed expression, which also is why their nulls are filled in ``room_area``."""
    df = plausible_rows(df, kind, run_date=run_date)
    df = fill_constants(df, zero_cols=[c for c in S.FILL_ZERO_COLUMNS if c not in S.ROOM_DIMS])
    condo_house = F.col("Type_own1_out").isin(S.CONDO_HOUSE_LABELS)
    df, med = fill_conditional_median(df, ["Depth", "Front_ft"], condo_house, medians)
    keep = communities if communities is not None else fit_rare_buckets(df, "Community")
    df = process_columns(df, keep)
    # the area of filled cells is never null and the flags only where their date is: nulls are looked for before them
    df = drop_incomplete(df.withColumn("Cd", F.col("Cd").cast("date")), distinct=False, unchecked=S.ROOM_DIMS)
    df = room_area(df, fill=0.0).drop(*S.ROOM_DIMS)
    return one_hot_ranges(one_hot_month(df)).distinct(), med, keep

