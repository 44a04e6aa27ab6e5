"""Scalar column functions (X-series). All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int) -> Column:
    """numpy-style rounding: scale, round half to even, unscale.

    ``bround`` rounds the decimal value and differs on binary fractions such as
    0.575; numpy rounds the scaled double, which ``rint`` reproduces.
    """
    scale = float(10 ** digits)
    return F.rint(_c(c) * F.lit(scale)) / F.lit(scale)


def log_price(c) -> Column:
    """log1p of a price or tax."""
    return F.log1p(_c(c))


def log_ratio(price, ref) -> Column:
    """Pair label: log1p(price) - log1p(ref)."""
    return F.log1p(_c(price)) - F.log1p(_c(ref))


def price_from_ratio(pair_price, pred_diff) -> Column:
    """Estimate from a comparable's price and a predicted log-ratio."""
    return _c(pair_price) / F.exp(_c(pred_diff))


def expm1_trunc(c) -> Column:
    """expm1 then truncate to a whole number."""
    return F.expm1(_c(c)).cast("long")


def scale_fixed(c, lo, hi, top: float = 100.0) -> Column:
    """Scale to [0, top] with given bounds."""
    return (_c(c) - _c(lo)) / (_c(hi) - _c(lo)) * F.lit(top)


def unscale_fixed(c, lo, hi, top: float = 100.0) -> Column:
    """Inverse of :func:`scale_fixed`."""
    return _c(c) / F.lit(top) * (_c(hi) - _c(lo)) + _c(lo)


def recode(c, mapping: dict) -> Column:
    """Categorical recode through a literal map; unknown values give null."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def rel_diff(ref, pred) -> Column:
    """|ref - pred| / ref, null when ref is 0."""
    return F.abs(F.try_divide(_c(ref) - _c(pred), _c(ref)))


def signed_rel_diff(pred, true) -> Column:
    """(pred - true) / true (X8, signed form)."""
    return F.try_divide(_c(pred) - _c(true), _c(true))


def underscore_names(c) -> Column:
    """Replace '/' and ' ' by '_' (X10)."""
    return F.translate(_c(c), "/ ", "__")


def squish(c) -> Column:
    """Collapse whitespace runs to one space and trim (X11)."""
    return F.trim(F.regexp_replace(_c(c), r"\s+", " "))


def number_text(c) -> Column:
    """Text of a number the way Python's ``str(float)`` writes it for the
    values that occur in keys (whole numbers keep one decimal: ``1.0``)."""
    col = _c(c).cast("double")
    whole = F.format_string("%.1f", col)
    return F.when(col.isNull(), F.lit("nan")).when(
        col == F.floor(col), whole).otherwise(col.cast("string"))


def unit_key(addr, br, br_plus, bath) -> Column:
    """Composite key ``addr:br:br_plus:bath``; a zero bedroom-plus is empty."""
    plus = F.when(_c(br_plus).cast("double") == 0, F.lit("")).otherwise(number_text(br_plus))
    return F.concat_ws(":", F.coalesce(_c(addr).cast("string"), F.lit("nan")),
                       number_text(br), plus, number_text(bath))


def key_head(key) -> Column:
    """Part before the first ':' (X13)."""
    return F.substring_index(_c(key), ":", 1)


def key_tail(key) -> Column:
    """Part after the first ':' (X13)."""
    return F.split(_c(key), ":", 2).getItem(1)


def file_timestamp(name) -> Column:
    """Largest run of digits in a file name, null when there is none."""
    runs = F.regexp_extract_all(_c(name), F.lit(r"(\d+)"), 1)
    return F.array_max(F.transform(runs, lambda s: s.cast("decimal(38,0)")))


def hash_timestamp(name) -> Column:
    """Text after the last '#', without the 4-character suffix."""
    tail = F.substring_index(_c(name), "#", -1)
    return F.substring(tail, F.lit(1), F.length(tail) - 4)


def approx_days(start_ts, end_ts) -> Column:
    """Day span of two ``yyyymmdd...`` texts as 365*dy + 30*dm + dd."""
    def part(c, a, n):
        return F.substring(_c(c), a, n).cast("int")
    return ((part(end_ts, 1, 4) - part(start_ts, 1, 4)) * 365
            + (part(end_ts, 5, 2) - part(start_ts, 5, 2)) * 30
            + (part(end_ts, 7, 2) - part(start_ts, 7, 2)))


def try_double(c) -> Column:
    """float() that tolerates bad text: null instead of an error."""
    return _c(c).try_cast("double")


def std_share(price, share: float) -> Column:
    """Price spread as a fixed share of the price."""
    return _c(price) * F.lit(share)


def nearest_value(ref, candidates: list[str]) -> Column:
    """Nearest candidate to ``ref`` and its relative distance.

    Returns a struct(diff, prio, value). On equal distance the candidate
    listed *later* wins (higher priority).
    """
    items = [F.struct(rel_diff(ref, c).alias("diff"), (-F.lit(i)).alias("prio"),
                      _c(c).cast("double").alias("value"))
             for i, c in enumerate(candidates)]
    return F.array_min(F.array(*items))


def seeded_hash(c, seed: int) -> Column:
    """60-bit integer from md5(text(c) + '|' + seed): first 15 hex digits.

    Stable across engines, partitionings and retries; DuckDB computes the same
    number with ``('0x' || substr(md5(x), 1, 15))::BIGINT``.
    """
    text = F.concat(_c(c).cast("string"), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


HASH_SPACE = 1 << 60


def mix_hashes(a, b) -> Column:
    """(a + b) mod 2**60 of two :func:`seeded_hash` values (no overflow)."""
    return F.pmod(_c(a) + _c(b), F.lit(HASH_SPACE))


def leading_number(c) -> Column:
    """First run of digits of a text as double; null when none (F8)."""
    digits = F.regexp_extract(_c(c).cast("string"), r"(\d+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("double")
