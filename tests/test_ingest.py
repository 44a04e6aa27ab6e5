"""File sources and the file stream: columns by header name, the gate, and repeated batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.sources import files as IO
from hedonic.streaming import ingest as ST

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                       T.StructField("k", T.DoubleType())])


def _write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / (name.replace("__", "#") + ".csv")).write_text(text)


def test_columns_are_read_by_header_name(spark, tmp_path):
    _write(tmp_path / "in", one="a,b,k\n1,x,0.5\n", two='k,"b",a\n1.5,"y, z",2\n', three="a,k\n3,bad\n",
           four="a,b,k\n", five="")
    rows = IO.read_listings(spark, str(tmp_path / "in"), SCHEMA).select("a", "b", "k", "source_file").collect()
    assert sorted(map(tuple, rows)) == [(1, "x", 0.5, "one.csv"), (2, "y, z", 1.5, "two.csv"),
                                        (3, None, None, "three.csv")]
    assert IO.read_distinct(spark, str(tmp_path / "in"), SCHEMA).count() == 3


def test_gate_and_repeated_batch(spark, tmp_path):
    _write(tmp_path / "in", Sold__1="a,b,k\n1,x,0.5\n4,,\n", Listing__2="k,b,a\n1.5,y,2\n", Sold__3="a,k\n3,2\n",
           Sold__4="a,b,k\n", Sold__5="\n", Sold__7="", Other="a,b,k\n9,z,1\n", Sold__6="a,b,k\n5,,1\n")
    files = spark.read.format("binaryFile").load(str(tmp_path / "in")).select(
        IO.decoded(F.col("_metadata.file_path")).alias("path"))
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for _ in range(2):      # a repeated batch replaces its own output
        ST.route_batch(files, 7, SCHEMA, ["a", "b"], lambda df: F.lit("house"), out, bad)
    got = spark.read.parquet(out).select("feed", "a", "b", "k").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [
        ("Sold", 1, "x", 0.5), ("Sold", 4, None, None), ("Listing", 2, "y", 1.5), ("Sold", 5, None, 1.0)]))
    rejected = {r["source_file"]: (r["reason"], r["n_rows"]) for r in spark.read.parquet(bad).collect()}
    assert rejected == {"Sold#3.csv": ("missing: b", 1), "Sold#4.csv": ("no rows", 0),
                        "Sold#5.csv": ("no header", 0), "Other.csv": ("bad name", 1)}


def test_compaction_survives_replays_and_stops(spark, tmp_path, monkeypatch):
    from hedonic.sources.files import read_slices
    from hedonic.streaming import compaction as K
    paths = tuple(f"{tmp_path}/{n}" for n in ("shards", "slices", "manifest"))
    how = {"date_col": "d", "key": "k", "tie_col": "v"}

    def shard(n, *rows):
        df = spark.createDataFrame(list(rows), "k string, d string, v int, file_ts string")
        return K.write_shard(df, n, paths[0], paths[2])

    def slices():
        return sorted((r["slice_id"], r["k"], r["v"]) for r in read_slices(spark, paths[1]).collect())

    assert K.compact(spark, *paths, **how) is None
    assert shard(0, ("a", "2024-01-01", 1, "20240101")) and K.compact(spark, *paths, **how) is None
    assert shard(1, ("a", "2024-01-20", 2, "20240121"), ("b", "2024-01-20", 9, "20240121"))
    assert K.compact(spark, *paths, **how) is None       # a span of exactly 20 days waits
    assert shard(2, ("c", None, 3, "20240122"), ("a", "2024-01-20", 1, "20240122"))
    with monkeypatch.context() as m:                     # stopped after the slice, before the manifest
        m.setattr(K, "write_slices", lambda df, path, real=K.write_slices: real(df, path) if path == paths[1] else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            K.compact(spark, *paths, **how)
    want = [(0, "a", 2), (0, "b", 9), (0, "c", 3)]
    with monkeypatch.context() as m:                     # stopped after the manifest, before the shards are removed
        m.setattr(K, "_remove", lambda spark, path, names: None)
        assert K.compact(spark, *paths, **how) == 0
    assert slices() == want and K.shard_names(spark, paths[0]) == ["batch=0", "batch=1", "batch=2"]
    assert not shard(1, ("z", "2024-03-01", 5, "20240301"))   # replayed
    assert K.compact(spark, *paths, **how) is None
    assert slices() == want and K.shard_names(spark, paths[0]) == []
    assert shard(3, ("a", "2024-02-01", 7, "20240201"), ("a", "2024-03-05", 8, "20240305"))
    assert K.compact(spark, *paths, **how) == 1
    assert slices() == [*want, (1, "a", 8)]


def test_nearby_sales_of_the_last_days(spark):
    from hedonic.operators import correct as R
    sold = spark.createDataFrame([(0.0, 0.0, "2024-07-19"), (0.027, -0.037, "2024-01-01"), (0.0, 0.0, "2023-12-31"),
                                  (0.0, 0.0, None), (0.0, 0.0, "2024-07-20")], "lat double, lng double, d string")
    at = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 5.0)], "_id int, lat double, lng double")

    def count(**kw):
        return {r["_id"]: r["nearby"] for r in R.nearby_count(at, sold, **kw).collect()}

    assert count() == {1: 5, 2: 0}
    assert count(date_col="d", as_of="2024-07-19") == {1: 2, 2: 0}
    assert count(date_col="d") == {1: 2, 2: 0}
