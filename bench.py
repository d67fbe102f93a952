"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query, the best one counts (default 2)
BENCH_ALL     set to 1 to time every query of the workload
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import build_session  # noqa: E402
from tidemark.workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "mart_user_post_summary",
    "mart_comment_statistics",
    "mart_user_post_summary_rel",
    "mart_comment_statistics_rel",
    "mart_incremental",
    "stg_users",
    "stg_posts",
    "stg_comments",
    "latest_per_key",
    "agg_by_post",
    "agg_by_user",
    "join_inner_agg",
    "join_lookup",
    "dq_suite",
    "dq_relationships",
    "reconcile_counts",
    "upsert_replace",
    "upsert_buckets",
    "cdc_apply",
    "cdc_out_of_order",
    "replicate_batch",
    "replicate_by_stamp",
    "ingest_users",
    "partition_prune",
    "stream_replicate",
    "stream_upsert",
    "stream_upsert_merged",
)

# Tables a query reads, for rows per second.
INPUTS = {
    "mart_user_post_summary": ("customer", "documents", "conversations"),
    "mart_comment_statistics": ("customer", "documents", "conversations"),
    "mart_user_post_summary_rel": ("customer", "orders", "lineitem"),
    "mart_comment_statistics_rel": ("customer", "orders", "lineitem"),
    "latest_per_key": ("events",),
    "agg_by_post": ("lineitem",),
    "join_inner_agg": ("orders", "lineitem"),
    "upsert_replace": ("customer", "supplier"),
    "cdc_apply": ("customer", "events"),
    "reconcile_counts": ("customer", "documents", "conversations"),
    "stream_replicate": ("events",),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = list(QUERIES) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        conf={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = {t for names_read in INPUTS.values() for t in names_read}
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in tables}

    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            # The noop sink computes every column of every row and stores nothing.
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    rate = {
        name: round(sum(rows[t] for t in INPUTS[name]) / seconds[name])
        for name in names
        if name in INPUTS
    }
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rate,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
