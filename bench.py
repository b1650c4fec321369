"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     runs per query, the fastest counts (default 2)
BENCH_SHARED   folder for checkpoints (default a new one)
BENCH_QUERIES  comma-separated names instead of the headline list, or "all"
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from nightledger.queries import QUERIES

HEADLINE = [
    "room_dwell_soft",
    "room_dwell_on_air",
    "lobby_stay",
    "second_spend",
    "asof_attribution",
    "income_detail",
    "income_pivot",
    "first_pay_per_class",
    "dedupe_keep_first",
    "spend_fact",
    "pattern_best_discount",
    "signup_steps",
    "partner_settlement",
    "first_pay_subtotals",
    "returning_metrics",
    "host_earnings_hour",
    "retention_week_month",
    "slot_pivot",
    "channel_quality",
]


def session(cpus: int) -> SparkSession:
    """A local session; one machine is its own shared folder."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = HEADLINE if not chosen else list(QUERIES) if chosen == "all" else chosen.split(",")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
