"""Versioned state: commits, pins, expiry, and what a stopped run leaves."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hedonic.operators import clean as C
from hedonic.operators import retrain as R
from hedonic.sources import files as IO
from hedonic.sources.versions import Versions


def _numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_versions_are_whole_or_absent(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "store"))
    assert store.current() is None and store.committed() == []
    with pytest.raises(LookupError):
        store.read("t")
    assert store.publish({"t": _numbers(spark, 1, 2)}) == 1
    stopped = store.begin()
    store.write(stopped, {"t": _numbers(spark, 9)})          # never committed
    assert (stopped, store.current()) == (2, 1)
    assert store.publish({"t": _numbers(spark, 3)}) == 3     # the stopped run's number is not used again
    assert [r.v for r in store.read("t").collect()] == [3]
    assert sorted(r.v for r in store.read("t", 1).collect()) == [1, 2]
    with pytest.raises(Exception, match="3"):
        store.commit(3)


def test_batch_keeps_its_version(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "store"))
    with pytest.raises(LookupError):
        store.pin(0)
    store.publish({"t": _numbers(spark, 1)})
    assert store.pin(0) == 1
    store.publish({"t": _numbers(spark, 2)})
    store.publish({"t": _numbers(spark, 3)})
    assert store.pin(0) == 1        # run again after a rebuild
    store.expire(1)
    assert store.committed() == [1, 3]
    assert store.pin(1) == 3
    store.expire(1)
    assert store.committed() == [3]


def test_saved_medians_are_used_unless_all_are_zero(spark):
    df = spark.createDataFrame([(1, None, 4.0, False), (2, 6.0, None, False), (3, 2.0, 8.0, False), (4, None, None, True)],
                               "k int, a double, b double, z boolean")

    def filled(medians):
        out, _ = C.fill_conditional_median(df, ["a", "b"], F.col("z"), medians)
        return [(r.a, r.b) for r in out.orderBy("k").collect()]

    def saved(a, b):
        return spark.createDataFrame([(a, b)], "a_median double, b_median double")

    assert filled(None) == filled(saved(0.0, 0.0)) == [(4.0, 4.0), (6.0, 6.0), (2.0, 8.0), (0.0, 0.0)]
    assert filled(saved(0.0, 7.0)) == [(0.0, 4.0), (6.0, 7.0), (2.0, 8.0), (0.0, 0.0)]


def _sliced(spark, n):
    """``n`` slices of ten days with four sales each."""
    days = spark.range(n * 4).select(F.col("id").alias("k"), (F.floor(F.col("id") / 4) + 1).cast("int").alias("slice_id"),
                                     (F.lit(1000.0) + F.col("id") % 5).alias("p"))
    return days.withColumn("d", F.expr("date_add(DATE '2020-01-01', CAST((slice_id - 1) * 10 + k % 4 AS INT))")) \
               .withColumn("lp", F.log1p("p"))


HOW = {"id_col": "k", "date_col": "d", "price_col": "p", "feature_cols": ("lp",), "max_iter": 2}


def test_training_after_a_shrinking_rebuild_and_a_stopped_run(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "store"))
    assert R.last_run(store) is None

    def slices():
        path = store.folder(R.last_run(store)["pairs_version"], "pairs")
        return sorted(r.slice_id for r in IO.read_slices(spark, path).select("slice_id").distinct().collect())

    assert R.training_flow(_sliced(spark, 6), store, **HOW) == 1 and slices() == [1, 2, 3, 4, 5, 6]
    assert R.training_flow(_sliced(spark, 6), store, **HOW) is None
    assert R.training_flow(_sliced(spark, 3), store, full=True, **HOW) == 2 and slices() == [1, 2, 3]

    def fails(_, __):
        raise OSError("stop")
    with pytest.raises(OSError):
        R.training_flow(_sliced(spark, 5), store, steps=(fails,), **HOW)
    assert R.last_run(store)["last_slice"] == 3                 # pairs were written, the run was not committed
    seen = []
    assert R.training_flow(_sliced(spark, 5), store, steps=(lambda s, v: seen.append(v),), **HOW) == seen[0] == 4
    assert slices() == [1, 2, 3, 4, 5] and R.last_run(store)["pairs_version"] == 2
    whole = tmp_path / "whole"
    R.build_pairs(_sliced(spark, 5), str(whole), **{k: v for k, v in HOW.items() if k != "max_iter"})
    got = IO.read_slices(spark, store.folder(2, "pairs")).select("target_id", "pair_id", "slice_id")
    want = IO.read_slices(spark, str(whole)).select("target_id", "pair_id", "slice_id")
    assert sorted(got.collect()) == sorted(want.collect())
    R.expire_models(store, 1)
    assert store.committed() == [2, 4]                          # the newest and the owner of its pairs
    model, mean = R.load_model(store)
    assert mean == R.last_run(store)["mean"] and model.stages[-1].factors.numRows == 2
