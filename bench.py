"""Benchmark the headline queries.

Runs each query fully (noop sink: every row is produced, nothing collected)
on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``
and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "comparables_estimate",
    "comparables_pair_counts",
    "listing_estimate_predict_band",
    "slice_assignment",
    "condo_quantiles",
    "condo_price_rules",
    "cosine_neighbors",
    "nearby_sold_count",
    "listing_price_correction",
    "accuracy_summary",
    "error_histogram",
    "clean_conditional_median_fill",
    "room_area_buckets",
    "chronological_split",
    "neighbor_vote_nudge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from hedonic.plans.catalog import load_all
    from hedonic.session import get_spark

    spark = get_spark("hedonic-bench", master=f"local[{cpus}]",
                      shuffle_partitions=max(int(cpus) * 2, 8),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    reg = load_all()
    # warm the JVM and the parquet reader once; not timed
    spark.read.parquet(os.path.join(sf_dir, "orders.parquet")).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        if name not in reg:
            continue
        t0 = time.perf_counter()
        df = reg[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
