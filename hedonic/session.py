"""Spark session and cluster-facing helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on: AQE re-plans joins from runtime sizes (the size
# check behind every broadcast we do not hint ourselves), splits skewed join
# partitions and coalesces small shuffle outputs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "hedonic", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local["):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` must point at storage that driver
    and executors share; without it this raises instead of falling back to a
    folder of one machine. Only with a local master (tests) a scratch folder
    is made.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = path.get() if path.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="hedonic-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Every later read gets the same rows (ids included) and a lost executor
    costs a re-read, not a recomputation of the lineage.
    """
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), f"hedonic-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Remove the folder that ``materialise`` wrote for ``df``, which can't be read any more."""
    folders = {os.path.dirname(f) for f in df.inputFiles()}
    spark = df.sparkSession
    for folder in folders:
        if not os.path.basename(folder).startswith("hedonic-"):
            raise ValueError(f"not written by materialise: {folder}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_broadcast(df: DataFrame, bound: int) -> DataFrame:
    """Broadcast a side after counting it: at most ``bound`` rows.

    A larger side is returned without a hint, so that Catalyst joins it by a
    shuffle. Pass materialised or cheap sides, as counting runs them.
    """
    if bound <= 0:
        raise ValueError("bound must be positive")
    return F.broadcast(df) if df.count() <= bound else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the parquet tables of a data folder."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
