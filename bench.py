"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the folder of tables, ``BENCH_CPUS`` the number of local cores, ``BENCH_RUNS`` how often each query
runs after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changeflow.plans.catalog import QUERIES  # noqa: E402
from changeflow.session import build_session  # noqa: E402

HEADLINES = [
    "parse_envelope",
    "tag_event",
    "enrich_json",
    "route_outbox",
    "current_state",
    "current_state_live",
    "changelog_ordered",
    "sink_routed",
    "statement_set",
    "parity_orders",
    "parity_hash",
    "exactly_once",
    "op_lifecycle",
    "contract_report",
    "metric_increase",
    "alert_restart_loop",
    "declared_link_multi",
]


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        timed(spark, folder, name)
        seconds[name] = round(statistics.median(timed(spark, folder, name) for _ in range(runs)), 3)
    result = {
        "metric": "headline queries, median seconds each, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")),
        "cpus": int(cpus),
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
