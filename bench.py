"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

One warm-up pass over all queries, then $BENCH_RUNS timed runs each; a run
builds the query (loads write their warehouse versions while building) and
executes it completely with the ``noop`` sink. Prints one JSON line with the
per-query medians, their sum, and under ``build`` and ``execute`` the medians of
the two parts, so that a change of the view or an aggregate shows beside its load.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starload.plans.catalog import QUERIES  # noqa: E402
from starload.session import build_session  # noqa: E402

HEADLINE = [
    "monthly_agg",
    "left_join_month",
    "src_tsv",
    "src_preamble_glob",
    "bi_flat_view",
    "seasonality",
    "upsert_fact",
    "idempotent_reload",
    "surrogate_keys",
    "dim_key_lookup",
    "fact_rejects",
]


def run_once(spark, name: str, sf_dir: str) -> tuple[float, float, float]:
    """Seconds in total, to build and to execute."""
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    t1 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    t2 = time.perf_counter()
    return t2 - t0, t1 - t0, t2 - t1


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        app="starload-bench",
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    for n in names:  # warm-up: JIT, file listing caches
        run_once(spark, n, sf_dir)
    medians, build, execute = {}, {}, {}
    for n in names:
        times = [run_once(spark, n, sf_dir) for _ in range(runs)]
        for out, part in zip((medians, build, execute), zip(*times)):
            out[n] = round(statistics.median(part), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "build": build,
        "execute": execute,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
