"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from rowtide import build_session
from rowtide.session import configure
from rowtide.workload.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "parse_events",
    "typed_rows",
    "catalog_types",
    "null_fill",
    "batch_counts",
    "latest_per_key",
    "latest_per_key_composite",
    "ordered_changes",
    "merge_upsert",
    "merge_delete",
    "merge_event_order",
    "merge_arrival",
    "merge_stored_event_order",
    "merge_table_event_order",
    "merge_table_compacted_between",
    "registered_after_merges",
    "snapshot_load",
    "fanout_tables",
    "stream_replay",
    "batch_job",
]


def session():
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": CPUS,
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": CPUS,
            # partitions sized for one machine, so that small data still uses every core
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = session()
    QUERIES["batch_counts"](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # warm-up
    times = {
        name: timed(lambda n=name: QUERIES[n](spark, SF_DIR).write.format("noop").mode("overwrite").save())
        for name in HEADLINE
    }
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
