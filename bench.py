"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the cores. Every query
runs once unmeasured, then up to three times; its figure is the median. The features run once
more over the events ten times over, where the plan and not its fixed cost decides.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time
from statistics import median

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from catalog import queries as Q

HEADLINE = (
    "scan_logs", "incremental_filter", "validate_trace", "enrich_trace", "gatekeeper",
    "trace_documents", "increment_occurrence", "batch_metrics", "semantic_text",
    "chronological_logs", "merge_on_duplicate",
)
#: No further run begins once a query has taken so long.
ENOUGH_SECONDS = 10
COPIES = 10


def seconds(query, spark: SparkSession, sf: str) -> float:
    start = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def measured(query, spark: SparkSession, sf: str) -> float:
    runs = [seconds(query, spark, sf)]
    spent = runs.pop()
    while len(runs) < 3 and (not runs or spent < ENOUGH_SECONDS):
        runs.append(seconds(query, spark, sf))
        spent += runs[-1]
    return round(median(runs), 3)


def copied(spark: SparkSession, sf: str, folder: str) -> str:
    """The events several times, as traces of other users."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    users, rows = events.agg(F.max("user_id") + 1, F.max("event_id") + 1).first()
    copies = spark.range(COPIES).withColumnRenamed("id", "copy")
    # Multiples of 330 keep the remainders by which the fixture derives its columns.
    step = (users // 330 + 1) * 330
    many = events.join(F.broadcast(copies)).select(
        (F.col("event_id") + F.col("copy") * (rows // 100 + 1) * 100).alias("event_id"), "ts",
        (F.col("user_id") + F.col("copy") * step).alias("user_id"), "event_type", "value", "props",
    )
    many.write.parquet(f"{folder}/events.parquet")
    return folder


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = Q.registered()
    took = {name: measured(registered[name], spark, sf) for name in HEADLINE}
    larger = copied(spark, sf, f"{shared}/larger")
    took_larger = {"enrich_trace": round(seconds(registered["enrich_trace"], spark, larger), 3)}
    log_rows = spark.read.parquet(f"{sf}/events.parquet").count()
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": sf.rsplit("sf", 1)[-1],
        "larger": {"copies": COPIES, "queries": took_larger},
        "rows_per_sec": {
            "features": round(log_rows / took["enrich_trace"]),
            "features_larger": round(log_rows * COPIES / took_larger["enrich_trace"]),
            "gate": round(log_rows / took["gatekeeper"]),
            "end_to_end": round(log_rows / took["trace_documents"]),
        },
    }))
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)


if __name__ == "__main__":
    main()
