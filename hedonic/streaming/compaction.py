"""Shard to slice compaction with a manifest (T4).

Incremental batches are *shards*: one folder each under a shard path. When the
shards not yet compacted span more than ``SPAN_DAYS`` days by their file names,
their latest rows per key become the next slice. A manifest, one small file per slice with the
shards it took, is the state: a slice is numbered by it, written, entered there
and only then are its shards removed. A run that stops in between is made good by the
next one: a slice without an entry is written again under its number, shards
with an entry are removed, and a batch that is replayed after its shard was taken adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.functions.scalar import approx_days
from hedonic.operators.slices import dedup_latest
from hedonic.sources.files import read_slices, write_slices

SPAN_DAYS = 20   # fixed value
_MANIFEST = T.StructType([T.StructField("shard", T.StringType()), T.StructField("slice_id", T.IntegerType())])


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shard_names(spark: SparkSession, shards: str) -> list[str]:
    """Shards that exist: a folder a batch since the last compaction."""
    fs, p = _folder(spark, shards)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def manifest_of(spark: SparkSession, manifest: str) -> DataFrame:
    """(shard, slice_id) of all committed slices."""
    return read_slices(spark, manifest, schema=_MANIFEST)


def write_shard(rows: DataFrame, batch_id: int, shards: str, manifest: str) -> bool:
    """Write a batch as a shard, over what an earlier try wrote; not if a slice has taken it already."""
    name = f"batch={batch_id}"
    if not manifest_of(rows.sparkSession, manifest).where(F.col("shard") == name).isEmpty():
        return False
    rows.write.mode("overwrite").parquet(f"{shards}/{name}")
    return True


def compact(spark: SparkSession, shards: str, slices: str, manifest: str, *, date_col: str, key: str,
            tie_col: str | None = None, ts_col: str = "file_ts", span_days: int = SPAN_DAYS, first: int = 0) -> int | None:
    """Turn the waiting shards into the next slice if their files (``ts_col``: yyyymmdd... of the file's name) span more
    than ``span_days`` days (X16). Returns its number, or None. Slices are numbered from ``first``."""
    waiting = shard_names(spark, shards)
    names = spark.createDataFrame([(n,) for n in waiting], "shard string")
    taken = {r["shard"] for r in manifest_of(spark, manifest).join(names, "shard").collect()}   # of those that exist
    _remove(spark, shards, taken)
    waiting = [n for n in waiting if n not in taken]
    if not waiting:
        return None
    rows = spark.read.parquet(*[f"{shards}/{n}" for n in waiting])
    ts = F.col(ts_col).cast("string")
    span = rows.agg(approx_days(F.min(ts), F.max(ts))).first()[0]
    if span is None or span <= span_days:
        return None
    number = (manifest_of(spark, manifest).agg(F.max("slice_id")).first()[0])
    number = first if number is None else number + 1
    write_slices(dedup_latest(rows, key, date_col, tie_col).withColumn("slice_id", F.lit(number)), slices)
    commit = spark.createDataFrame([(n, number) for n in waiting], _MANIFEST)
    write_slices(commit.coalesce(1), manifest)
    _remove(spark, shards, waiting)
    return number


def _remove(spark: SparkSession, shards: str, names) -> None:
    for n in names:
        fs, p = _folder(spark, f"{shards}/{n}")
        fs.delete(p, True)
