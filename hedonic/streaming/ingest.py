"""Structured Streaming jobs (T1-T5); scoring and compaction are in modules of their own.

The landing folder is a file-stream source that lists files; each
micro-batch reads its files by their own headers with the batch readers and
writes to folders named by the batch id, so that a batch which is run again
after a failure replaces what it wrote before instead of adding to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.sources.files import decoded, file_headers, glob_literal, name_kind, name_ts, read_checked


def file_stream(spark: SparkSession, landing: str, max_files: int | None = None,
                archive: str | None = None) -> DataFrame:
    """Stream of landing files (T1): path, modificationTime, length; contents
    are pruned here. With ``archive``, finished files are moved there."""
    r = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return r.load(landing).select(decoded(F.col("_metadata.file_path")).alias("path"), "modificationTime", "length")


def batch_rows(files: DataFrame, schema: T.StructType, required: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of a micro-batch's files that pass the gate, tagged with feed and
    timestamp, and (source_file, reason, n_rows) of the rejected files: a name
    without a known feed, a required column absent from the header, no rows."""
    spark = files.sparkSession
    paths = [glob_literal(r["path"]) for r in files.select("path").collect()]   # at most maxFilesPerTrigger names
    headers = file_headers(spark, paths)
    name = F.substring_index("path", "/", -1)
    headers = headers.withColumn("source_file", name).withColumn("feed", name_kind())
    known = headers.where(F.col("feed").isNotNull()).select("path", "header", "n_rows")
    rows, rejected = read_checked(spark, known, schema, required)
    stray = headers.where(F.col("feed").isNull()).select("path", F.lit("bad name").alias("reason"), "n_rows")
    rejected = rejected.unionByName(stray).select(name.alias("source_file"), "reason", "n_rows")
    return rows.withColumn("feed", name_kind()).withColumn("file_ts", name_ts()), rejected


def route_batch(files: DataFrame, batch_id: int, schema: T.StructType, required: list[str],
                kind_of: Callable[[DataFrame], F.Column], out: str, quarantine: str,
                clean: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """One micro-batch (T2, T3, T5): rejected files are listed with the reason
    under ``quarantine``, the rows of the others are cleaned and written under
    ``out`` by feed and kind; both in a folder of the batch id, overwritten when
    the batch is run again."""
    rows, rejected = batch_rows(files, schema, required)
    rejected.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
    rows = rows.withColumn("kind", kind_of(rows))
    if clean is not None:
        rows = clean(rows)
    rows.write.mode("overwrite").partitionBy("feed", "kind").parquet(f"{out}/batch={batch_id}")


def ingest_stream(spark: SparkSession, landing: str, out: str, quarantine: str, checkpoint: str,
                  schema: T.StructType, required: list[str], kind_of: Callable[[DataFrame], F.Column],
                  clean: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True,
                  interval: str = "60 seconds", max_files: int | None = None, archive: str | None = None):
    """Continuous ingest (T1-T3, T5): poll the landing folder (every
    ``interval``, or drain it once with ``available_now``), validate, route,
    clean and write. Returns the started query."""
    src = file_stream(spark, landing, max_files, archive)
    w = (src.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, n: route_batch(df, n, schema, required, kind_of, out, quarantine, clean)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def compact_shards(shards: DataFrame, date_col: str, key: str, span_days: int = 20,
                   tie_col: str | None = None) -> DataFrame:
    """Shard -> slice compaction (T4, W2): when the shards span more than
    ``span_days`` days, their rows (latest per key) form the next slice;
    otherwise nothing is emitted. The next slice number is assigned by the
    caller's sink (dynamic partition overwrite keeps a rerun idempotent)."""
    from hedonic.operators.slices import dedup_latest
    span = shards.agg((F.datediff(F.max(F.col(date_col).cast("date")), F.min(F.col(date_col).cast("date"))))
                      .alias("_span"))
    ready = shards.crossJoin(F.broadcast(span)).where(F.col("_span") > span_days).drop("_span")
    tie = tie_col or ("file_ts" if "file_ts" in shards.columns else None)
    return dedup_latest(ready, key, date_col, tie)
