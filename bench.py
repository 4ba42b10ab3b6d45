"""Timing of the headline queries: one warm-up, then the median of the runs. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 BENCH_RUNS=3 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from checks.catalog import CHECKS
from inventrace import session

HEADLINE = [
    "snapshot_diff",
    "upsert_state",
    "upsert_metrics",
    "upsert_composite_key",
    "history_emit",
    "attr_nearest_24h",
    "attr_field_fallback",
    "attr_latest",
    "attr_chain",
    "sig_all",
    "cmp_list_any",
    "cmp_json_object",
    "json_extract_priority",
    "change_summary_json",
    "res_cloudtrail_events",
    "event_dedup_insert",
    "ingest_funnel",
    "res_ec2",
    "res_subnets",
    "res_ssm",
    "res_athena",
    "compliance_rollup",
    "two_hop_set",
    "state_roundtrip",
    "history_append",
    "stream_audit_dedup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session.build(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "bench", tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        CHECKS[name].query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in sys.argv[1:] or HEADLINE:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
