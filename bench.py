"""Headline queries, timed: prints one JSON line.

Each query is built and run to completion into the no-op sink: once to warm up, then
three times, of which the median counts. Building is part of the time, because it runs
the small jobs that size the dimensions.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--conf spark.ui.showConsoleProgress=false pyspark-shell")

from tagloom.plans.queries import QUERIES  # noqa: E402
from tagloom.session import local_session  # noqa: E402

HEADLINE = [
    "q01_event_id", "q02_value_text", "q04_classify", "q05_canonical_event", "q09_grid_counts", "q10_interpolated",
    "q11_interpolated_events", "q12_snapshot_latest", "q16_dedup", "q17_merge", "q19_write_requests_valid",
    "q22_json_payload", "q25_stream_dedup_parity", "q33_stream_grid_parity",
]
SLOW = {"q17_merge", "q25_stream_dedup_parity", "q33_stream_grid_parity"}


def timed(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("tagloom-bench", cores=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = [timed(QUERIES[name], spark, sf_dir) for _ in range(2 if name in SLOW else 4)]
        seconds[name] = round(statistics.median(runs[1:]), 3)
        print(name, seconds[name], file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
