"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_QUERIES`` (comma list) choose data, cores and
queries. Each query runs in full into a sink that discards its rows. Before it is timed it
runs once on the smallest data set next to ``BENCH_SF_DIR``, if there is one, so that compiling
its code is not measured.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from weir import session
from weir.plans.catalog import QUERIES

HEADLINE = (
    "db_changes",
    "config_latest",
    "dim_route",
    "dim_upsert",
    "first_visit",
    "is_new_repair",
    "log_display",
    "log_fanout",
    "log_daily",
    "date_functions",
    "stream_first_visit",
    "stream_log_fanout",
    "stream_dim_upsert",
)


def run(name: str, spark, sf_dir: str) -> None:
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = (
        session.builder("weir-bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm_up = Path(sf_dir).parent / "sf0.001"
    seconds = {}
    for name in names:
        if warm_up.is_dir():
            run(name, spark, str(warm_up))
        start = time.perf_counter()
        run(name, spark, sf_dir)
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
