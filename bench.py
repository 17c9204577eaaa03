"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
BENCH_COPIES   copies of the events, with shifted ids and times (default 1)
BENCH_QUERIES  comma-separated names instead of the headline list
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

HEADLINE = (
    "decode_json_events",
    "enrich_left_join",
    "transform_all",
    "session_event_number",
    "minute_metrics",
    "campaign_analytics",
    "sliding_metrics",
    "hourly_rollup",
    "upsert_summary",
    "campaign_summary",
    "dead_letter",
    "event_points",
    "merge_points",
    "null_counts",
    "stream_minute_metrics",
    "stream_upsert",
    "stream_enriched_events",
)


def session(cpus: int) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def copied(spark: SparkSession, sf_dir: str, copies: int) -> str:
    """A folder whose events hold ``copies`` months of the original month; other tables as they are."""
    folder = tempfile.mkdtemp(prefix="bench-tables-")
    for name in os.listdir(sf_dir):
        if name != "events.parquet":
            os.symlink(os.path.join(sf_dir, name), os.path.join(folder, name))
    events = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    n = events.count()
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    many = many.withColumn("event_id", F.col("event_id") + F.col("copy") * n)
    many = many.withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.col("copy") * 31))
    many.drop("copy").repartition(16).write.parquet(os.path.join(folder, "events.parquet"))
    return folder


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tallyriver.plans.catalogue import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = session(cpus)
    tables = sf_dir if copies == 1 else copied(spark, sf_dir, copies)
    rows = spark.read.parquet(os.path.join(tables, "events.parquet")).count()

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "events": rows,
                "copies": copies,
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
