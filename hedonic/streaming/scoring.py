"""Continuous scoring with one published result per file timestamp.

A micro-batch splits its listing files into condos and houses, scores each with
its own scorer and writes the results into a folder of the batch id. That
folder is the state: what is published for a timestamp is the union of the
results of all batches that hold it, written over what was published before. So
files of one timestamp may come in several batches, and a batch that is
run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.session import bounded_broadcast
from hedonic.sources.files import merge_results, split_batch_files
from hedonic.streaming.ingest import batch_rows, file_stream

OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_STAMPS = 4              # files a task writes at the same time
BROADCAST_STAMPS = 100_000   # timestamps that are broadcast at most

Scorer = Callable[[DataFrame], DataFrame]


def score_batch(files: DataFrame, batch_id: int, schema: T.StructType, required: list[str], condos: Scorer, houses: Scorer,
                scored: str, published: list[str], quarantine: str, max_files: int | None = None) -> None:
    """One micro-batch. Scorers keep ``source_file`` and return the same columns. With ``max_files`` a timestamp of so
    many files or more is published no further."""
    rows, rejected = batch_rows(files, schema, required)
    rejected.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
    cd, hs = split_batch_files(rows)
    ts = F.coalesce(F.col("file_ts").cast("string"), F.lit("none"))
    out = condos(cd).withColumn("file_ts", ts).unionByName(houses(hs).withColumn("file_ts", ts))
    out.write.mode("overwrite").parquet(f"{scored}/batch={batch_id}")
    publish(files.sparkSession, scored, batch_id, published, max_files)


def publish(spark: SparkSession, scored: str, batch_id: int, published: list[str], max_files: int | None = None) -> None:
    """Write anew, in every place of ``published``, the timestamps that a batch has results of. A task with up to
    ``OPEN_STAMPS`` timestamps writes its rows as they come; only beyond are they sorted."""
    batch = spark.read.parquet(f"{scored}/batch={batch_id}")
    every = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("batch", T.LongType())])).parquet(scored)
    # the timestamps of one batch's files: at most as many as its files
    stamps = bounded_broadcast(batch.select("file_ts").distinct(), BROADCAST_STAMPS)
    merged = merge_results(every.join(stamps, "file_ts", "left_semi"), max_files=max_files)
    before = spark.conf.get(OPEN_WRITERS, None)
    spark.conf.set(OPEN_WRITERS, str(OPEN_STAMPS))
    try:
        for path in published:
            merged.drop("batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "file_ts").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(OPEN_WRITERS)
        else:
            spark.conf.set(OPEN_WRITERS, before)


def scoring_stream(spark: SparkSession, landing: str, schema: T.StructType, required: list[str], condos: Scorer,
                   houses: Scorer, scored: str, published: list[str], quarantine: str, checkpoint: str,
                   max_files: int | None = None, archive: str | None = None, available_now: bool = True,
                   interval: str = "60 seconds"):
    """Score waiting listing files every ``interval``, or once with ``available_now``; finished files are moved to
    ``archive``. Returns the started query."""
    src = file_stream(spark, landing, archive=archive)
    w = src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: score_batch(
        df, n, schema, required, condos, houses, scored, published, quarantine, max_files))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
