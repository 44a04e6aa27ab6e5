"""Driver contract: entry smoke run, registry shape, oracle parity on small data."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
FAST = ["comparables_estimate", "comparables_pair_counts", "slice_assignment", "condo_quantiles",
        "condo_price_rules", "error_histogram", "clean_conditional_median_fill", "room_area_buckets",
        "nearby_sold_count", "cosine_neighbors"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"_id", "mean_price", "std"}
    assert df.count() >= 0


def test_registry_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 40


@pytest.mark.parametrize("name", FAST)
def test_oracle_parity(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    cols = sorted(sp.columns)
    assert cols == sorted(dk.columns)
    assert len(sp) == len(dk)

    def rows(pdf):
        return sorted(repr(tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r))
                      for r in pdf[cols].itertuples(index=False))
    assert rows(sp) == rows(dk)
