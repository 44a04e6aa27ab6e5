"""Unit tests at the operator boundaries (hand-made rows) and properties."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hedonic.operators import clean as C
from hedonic.operators import correct as R
from hedonic.operators import evaluate as V
from hedonic.operators import slices as L
from hedonic.operators.pairs import TARGET_KEYS, comparables, estimate_from_pairs, sample_per_group, trimmed_estimate


def _d(s):
    return dt.date.fromisoformat(s)


def test_band_join_edges(spark):
    # target 1 at day 0 price 100; gaps 20 (kept) / 21 (dropped); ratio .10, .105 (rint -> .10, kept), .106
    rows = [(1, _d("2020-01-01"), 100.0), (2, _d("2020-01-21"), 100.0), (3, _d("2020-01-22"), 100.0),
            (4, _d("2020-01-02"), 110.0), (5, _d("2020-01-02"), 110.5), (6, _d("2020-01-02"), 110.6),
            (7, _d("2020-01-02"), None)]
    df = spark.createDataFrame(rows, "id long, d date, p double")
    pairs = comparables(df.where("id = 1"), df, id_col="id", date_col="d", price_col="p")
    got = sorted(r.pair_id for r in pairs.collect())
    assert got == [1, 2, 4, 5]          # self kept, 21 days out, .106 out, null price out


def test_bin_join_equals_theta_join(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    pairs = comparables(o, o, id_col="o_orderkey", date_col="o_orderdate", price_col="o_totalprice")
    t = o.select(F.col("o_orderkey").alias("t"), F.col("o_orderdate").cast("date").alias("td"),
                 F.col("o_totalprice").alias("tp"))
    c = o.select(F.col("o_orderkey").alias("c"), F.col("o_orderdate").cast("date").alias("cd"),
                 F.col("o_totalprice").alias("cp"))
    theta = t.crossJoin(c).where((F.abs(F.datediff("cd", "td")) <= 20)
                                 & (F.abs(F.rint((F.col("cp") - F.col("tp")) / F.col("tp") * 100) / 100) <= 0.1))
    assert pairs.count() == theta.count()


def test_sample_sizes(spark):
    rows = [(g, m) for g, n in [(1, 1), (2, 2), (3, 3), (4, 5), (5, 10)] for m in range(n)]
    df = spark.createDataFrame(rows, "g long, m long")
    s = sample_per_group(df, "g", "m").groupBy("g").count().orderBy("g").collect()
    assert [r["count"] for r in s] == [1, 2, 2, 4, 8]


def test_trimmed_estimate(spark):
    rows = [(1, 100.0), (2, 100.0), (2, 100.0), (3, 100.0), (3, 108.0), (3, 92.0), (3, 100.0)]
    out = {r["_id"]: r for r in trimmed_estimate(spark.createDataFrame(rows, "target_id long, pred_price double"))
           .collect()}
    assert out[1]["mean_price"] == 100 and out[1]["std"] == 4      # single row: std null -> 4 %
    assert out[2]["std"] == 4                                       # equal prices: std 0 -> 4 %
    assert out[3]["mean_price"] == 100                              # 8 % off members dropped


def test_plausible_rows_and_fill(spark):
    rows = [(1, 0.0, 60000.0, "2020-01-01"), (2, None, 50001.0, "2020-01-01"), (3, 1.0, 50000.0, "2020-01-01"),
            (4, 1.0, None, "2020-01-01"), (5, 1.0, 70000.0, None)]
    df = spark.createDataFrame(rows, "_id long, Taxes double, Sp_dol double, Cd string")
    kept = sorted(r._id for r in C.plausible_rows(df, "Sold").collect())
    assert kept == [2]


def test_room_area_edges(spark):
    # one room 1 x a: mean area a
    cases = [0.0, 1.0, 1.01, 99.9, 100.0, 700.0, 8000.0, 22500.0]
    rows = [(i, 1.0 if a else 0.0, a) for i, a in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, l double, w double")
    out = {r.i: r.Rooms_total_area for r in C.room_area(df, dims=["l", "w"]).collect()}
    assert 0 not in out                              # no rooms: dropped
    assert out[1] == 25.0                            # a = 1 is not > 1: rooms x 25
    assert abs(out[2] - 1.01) < 1e-12
    assert abs(out[4] - 100.0 / 10.7584) < 1e-12
    assert out[5] == 7.0 and abs(out[6] - 8000 / 1075.84) < 1e-12 and out[7] == 25.0


def test_area_buckets(spark):
    vals = [49.9, 50.0, 100.0, 150.0, 200.0, 250.0, 350.0]
    df = spark.createDataFrame([(v,) for v in vals], "Rooms_total_area double")
    out = C.one_hot_ranges(df, drop=False).collect()
    names = C.S.AREA_BUCKETS
    assert [names[[r[n] for n in names].index(1)] for r in out] == [
        "less-than50", "50-to-100", "100-to-150", "150-to-200", "200-to-250", "250-to-350", "larger-than350"]


def test_slices_property(spark):
    days = ["2020-01-01", "2020-01-20", "2020-01-21", "2020-02-09", "2020-02-10", "2020-04-10"]
    df = spark.createDataFrame([(i, _d(d)) for i, d in enumerate(days)], "id int, d date")
    m = {r.day.isoformat(): r.slice_id for r in L.day_to_slice(df, "d", 20, "2000-01-01").collect()}
    assert m == {"2020-01-01": 1, "2020-01-20": 1, "2020-01-21": 2, "2020-02-09": 2, "2020-02-10": 3,
                 "2020-04-10": 4}
    # rows before the anchor + interval form slice 1 ahead of the first opened start
    m2 = {r.day.isoformat(): r.slice_id for r in L.day_to_slice(df, "d", 20, "2020-01-01").collect()}
    assert m2["2020-01-01"] == 1 and m2["2020-01-21"] == 2


def test_error_histogram_edges(spark):
    rows = [(i, 100.0, p) for i, p in enumerate([100.0, 101.0, 103.0, 120.0, 200.0, 201.0])]
    df = spark.createDataFrame(rows, "_id long, Sp double, Pp double")
    h = {r.percent: r["count"] for r in V.error_histogram(V.with_error(df, cols=["_id", "Pp", "Sp"])).collect()}
    assert h[1] == 1 and h[3] == 1 and h[20] == 1 and h[100] == 1 and sum(h.values()) == 4
    empty = spark.createDataFrame([], "_id long, Sp double, Pp double")
    he = V.error_histogram(V.with_error(empty, cols=["_id", "Pp", "Sp"])).collect()
    assert len(he) == 100 and all(r.percentage is None for r in he)


def test_correct_prices_branches(spark):
    rows = [(1, 1000000.0, 0.0, 0.0, 0.0, 0.0, 0.0),          # all models missing
            (2, 2500000.0, 1000000.0, 0.0, 0.0, 0.0, 0.0),    # high lp, nearest within 1.24857
            (3, 1000000.0, 1100000.0, 1500000.0, 1500000.0, 0.0, 0.0),  # nearest .1 -> kept
            (4, 1000000.0, 1300000.0, 1300000.0, 1500000.0, 0.0, 0.0),  # nearest .3, 2 nearby -> kept
            (5, 1000000.0, 1300000.0, 700000.0, 1500000.0, 0.0, 0.0)]   # equal diffs: ada (later) wins
    df = spark.createDataFrame(rows, "_id long, Lp_dol double, gb_pred double, ada_pred double, rf_pred double, "
                                     "lat double, lng double")
    near = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 2), (5, 5)], "_id long, nearby long")
    out = {r._id: r for r in R.correct_prices(df.drop("lat", "lng"), near).collect()}
    assert [out[i].lp_changed for i in range(1, 6)] == [False, False, False, False, True]
    assert out[5].Lp_dol == 700000.0


def test_nearby_count_box(spark):
    idx = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.027, 0.037), (3, 0.0271, 0.0), (4, -0.01, -0.02)],
                                "_id long, lat double, lng double")
    out = {r._id: r.nearby for r in R.nearby_count(idx, idx).collect()}
    assert out[1] == 3 and out[3] == 2   # inclusive edges; 0.0271 is outside the first box


def test_chronological_split_sizes(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    n = o.count()
    head, tail = L.split_by_time(o, "o_orderdate", "o_orderkey", 0.1)
    assert tail.count() == int(n * 0.1) and head.count() == n - int(n * 0.1)
    assert head.agg(F.max("o_orderdate")).first()[0] <= tail.agg(F.min("o_orderdate")).first()[0]


def test_chronological_split_keeps_rows_of_repeated_ids(spark):
    rows = [(i % 7, f"2020-01-{1 + i % 9:02d}" if i % 11 else None, i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, d string, x int").withColumn("d", F.col("d").cast("date"))
    head, tail = L.split_by_time(df, "d", "id", 0.3)
    assert tail.count() == 120
    assert sorted(map(str, head.unionByName(tail).collect())) == sorted(map(str, df.collect()))


def test_box_edges_that_round_two_cells_apart(spark):
    df = spark.createDataFrame([(1, -62.019000000000005, 0.0), (2, -61.992000000000004, 0.0)],
                               "_id long, lat double, lng double")
    near = {r._id: r.nearby for r in R.nearby_count(df, df).collect()}
    want = {a[0]: sum(a[1] - 0.027 <= b[1] <= a[1] + 0.027 for b in df.collect()) for a in df.collect()}
    assert near == want


def test_slice_reader_takes_only_a_missing_path_as_empty(spark, tmp_path):
    from hedonic.sources import files as IO
    schema = spark.range(1).withColumn("slice_id", F.lit(1)).schema
    assert IO.read_slices(spark, str(tmp_path / "none"), schema=schema).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception):
        IO.read_slices(spark, str(tmp_path / "bad"), schema=schema).count()


def test_partition_names_that_are_no_number_are_skipped(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,), ("12",)], "slice_id string")
    assert L.max_partition(df).first()[0] == 12


def test_long_sparse_line_is_read_whole(spark, tmp_path):
    from hedonic.sources import files as IO
    (tmp_path / "t.txt").write_text("1.5 " + " ".join(f"0:{i}:1.0" for i in range(3000)))
    assert IO.read_sparse_text(spark, str(tmp_path)).select(F.size("feats")).first()[0] == 3000


@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
def test_exact_medians_equal_sorting(spark, limit):
    import random

    from hedonic.functions.exact import exact_medians
    rnd = random.Random(3)
    rows = [(rnd.gauss(0, 1), float(rnd.randrange(4)), None if k % 3 else rnd.random(), None) for k in range(5001)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = exact_medians(df, {c: F.col(c) for c in "abcd"}, limit)
    want = df.agg(*[F.median(c).alias(c) for c in "abcd"]).first().asDict()
    assert got == want
    two = exact_medians(df.limit(0).unionByName(df.sparkSession.createDataFrame(
        [(1.0, 2.0, 5.0, None), (4.0, 2.0, None, None)], df.schema)), {c: F.col(c) for c in "abcd"}, limit)
    assert two == {"a": 2.5, "b": 2.0, "c": 5.0, "d": None}


def test_cosine_blocks_and_ids(spark):
    from hedonic.operators import neighbors as N
    rows = [(f"a{k:03d}", f"t{j}", float((k * 7 + j * j * 3) % 11)) for k in range(60) for j in range(5)]
    m = spark.createDataFrame(rows, "addr string, ctype string, price double")
    edges = {b: sorted(map(repr, N.cosine_neighbors(m, k=7, blocks=b).select("addr", "nbr", "rank").collect()))
             for b in (1, 4)}
    assert edges[1] == edges[4] and len(edges[1]) >= 60 * 6
    ids = sorted(r["u"] for r in N.dense_ids(m, "addr", "u", buckets=8).collect())
    assert ids == list(range(60))


def test_chronological_holdout_and_pooled_scores(spark):
    from hedonic.operators import models as M
    rows = [(k, _d("2020-01-01") + dt.timedelta(days=k // 3), "g%d" % (k % 2), float(k % 7), float(k % 7) * 2 + k % 2)
            for k in range(300)]
    df = spark.createDataFrame(rows, "id long, d date, g string, x double, y double")
    head, tail = L.split_by_time(df, "d", "id", 0.2)
    _, held = M.train_stack(head, tail, ["x"], "y", "d", "id")
    assert held.count() == 6
    assert held.agg(F.min("d")).first()[0] >= tail.join(held, "id", "left_anti").agg(F.max("d")).first()[0]
    models = M.train_pooled_regressors(df.withColumn("p", F.lit("all")), "g", ["x"], "y", "p", ["all", "none"],
                                       draws=1, folds=2)
    new = spark.createDataFrame([(1, "g0", 3.0, "all"), (2, "unseen", 3.0, "all"), (3, "g0", None, "all"),
                                 (4, "g0", 1.0, None), (5, "g1", 1.0, "none")], "id long, g string, x double, period string")
    got = {r["id"]: (r["gb_pred"], r["rf_pred"]) for r in M.score_pooled_regressors(new, models, "g", ["x"]).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert all(abs(p - 6) < 2 for p in got[1]) and all(got[k] == (None, None) for k in (2, 3, 4, 5))


def test_salted_hot_bin_equals_theta_join(spark):
    rows = [(k, _d("2020-01-01") + dt.timedelta(days=k % 9), 100.0 + k % 13) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, d date, p double")
    kw = {"id_col": "id", "date_col": "d", "price_col": "p"}
    plain = comparables(df, df, **kw)
    salted = comparables(df, df, max_pairs=2000, **kw)
    assert salted.select("_ks").distinct().count() > 20     # one dense bin over many parts
    cols = ["target_id", "pair_id", "ratio"]
    theta = {(a[0], b[0]) for a in rows for b in rows if abs(round((b[2] - a[2]) / a[2], 2)) <= 0.1}
    got = [tuple(r) for r in salted.select(*cols).collect()]
    assert sorted(got) == sorted(tuple(r) for r in plain.select(*cols).collect())
    assert {g[:2] for g in got} == theta and len(got) == len(theta)

    def estimate(pairs):
        kept = sample_per_group(pairs, "target_id", "pair_id", partition_cols=TARGET_KEYS)
        return estimate_from_pairs(kept.withColumn("pred_diff", F.col("label") * 0.5))
    plan = estimate(salted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_kd") == 2          # the join's two inputs, nothing after
    assert sorted(map(tuple, estimate(salted).collect())) == sorted(map(tuple, estimate(plain).collect()))
