"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Two ingests build the stores the other queries read, as in use; they are timed like the rest.
Each query runs once after the session has been warmed up on the smallest tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metricspark import build_session  # noqa: E402
from metricspark.plans import registry  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")

QUERIES = (
    "encode_series",
    "stored_samples",
    "lineitem_by_status",
    "lineitem_by_supplier",
    "time_range_scan",
    "metric_view_error",
    "series_view_error",
    "sel_and",
    "sel_nre",
    "sel_across_metrics",
    "group_by_label",
    "group_by_user",
    "decode_series",
    "metric_info",
    "label_info",
    "parse_round_trip",
    "parse_families",
    "label_escapes",
    "age_filter",
    "remote_write_rows",
    "retention_series",
    "fold_targets",
    "ingest_report",
)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = registry.queries()

    def run(name: str, sf_dir: str) -> None:
        catalogue[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    if os.path.isdir(WARM_DIR):
        for name in QUERIES:
            run(name, WARM_DIR)
    took = {}
    for name in QUERIES:
        started = time.perf_counter()
        run(name, SF_DIR)
        took[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
