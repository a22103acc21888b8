"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores. Each query runs
once to warm up and then twice; the better time counts. Results are computed whole, into Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lakeops.session import build_session
from suite import QUERIES

HEADLINE = [
    "acquisition_windows",
    "acquisition_report_day",
    "acquisition_by_day",
    "conditional_distinct_counts",
    "close_status",
    "upsert_day",
    "upsert_day_null_safe",
    "upsert_range",
    "delete_insert_range",
    "change_classes",
    "history_replay",
    "history_replay_changes",
    "history_restore_day",
    "row_hashes",
    "clean_text",
    "map_columns",
    "date_keys_of_names",
    "repair_linebreak",
    "detect_pairs",
    "join_fragments",
    "json_list_wide",
    "grid_to_records",
    "csv_multiline",
    "partition_replace",
    "ingest_folder",
    "stream_ingest",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "lakeops-bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run = lambda: QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        run()
        seconds[name] = round(min(timed(run), timed(run)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
