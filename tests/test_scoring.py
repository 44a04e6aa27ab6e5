"""Publishing of scored timestamps."""

from __future__ import annotations

from pyspark.sql.readwriter import DataFrameWriter

from hedonic.streaming import scoring as P


def test_timestamps_are_published_without_a_sort_of_their_rows(spark, tmp_path, monkeypatch):
    def batch(n, rows):
        spark.createDataFrame(rows, "event_id long, file_ts string").coalesce(1).write.parquet(f"{tmp_path}/scored/batch={n}")

    batch(0, [(k, f"t{k % 7}") for k in range(700)])          # more timestamps than files that a task opens
    batch(1, [(1000 + k, f"t{k % 2}") for k in range(10)])
    seen, write = [], DataFrameWriter.parquet

    def recorded(self, path, *args, **kwargs):
        seen.append((spark.conf.get(P.OPEN_WRITERS), self._df._jdf.queryExecution().executedPlan().toString()))
        write(self, path, *args, **kwargs)

    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as for results beyond it
    before = spark.conf.get(P.OPEN_WRITERS, None)
    try:
        P.publish(spark, f"{tmp_path}/scored", 0, [f"{tmp_path}/a"])
        first = {t: spark.read.parquet(f"{tmp_path}/a/file_ts={t}").count() for t in ("t0", "t1", "t6")}
        P.publish(spark, f"{tmp_path}/scored", 1, [f"{tmp_path}/a", f"{tmp_path}/b"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert first == {"t0": 105, "t1": 105, "t6": 100}
    assert spark.conf.get(P.OPEN_WRITERS, None) == before
    assert len(seen) == 3 and all(conf == str(P.OPEN_STAMPS) and "SortMergeJoin" not in plan for conf, plan in seen)
    got = {r["file_ts"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/a").groupBy("file_ts").count().collect()}
    assert got == {"t0": 105, "t1": 105, "t2": 100, "t3": 100, "t4": 100, "t5": 100, "t6": 100}
    assert sorted(r["file_ts"] for r in spark.read.parquet(f"{tmp_path}/b").select("file_ts").distinct().collect()) == ["t0", "t1"]
