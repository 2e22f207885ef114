"""Failed traces: what is recorded, what is skipped, when a batch is bad."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.config import EngineConfig
from tracemill.schemas import QUARANTINE


def poisoned(quarantine: DataFrame, cfg: EngineConfig) -> DataFrame:
    return quarantine.where(F.col("count") >= cfg.poison_pill_max_failures).select("correlation_id")


def skip_poison(rows: DataFrame, quarantine: DataFrame, cfg: EngineConfig) -> DataFrame:
    return rows.join(poisoned(quarantine, cfg), "correlation_id", "left_anti")


def failures(failed: DataFrame, as_of: int) -> DataFrame:
    """One failure record per failed trace of a batch."""
    seen = F.timestamp_seconds(F.lit(as_of))
    return failed.select("correlation_id", "error", seen.alias("seen"))


def quarantine_from(records: DataFrame) -> DataFrame:
    """Fold failure records into one entry per trace."""
    return records.groupBy("correlation_id").agg(
        F.count("*").alias("count"),
        F.max(F.struct("seen", "error"))["error"].alias("last_error"),
        F.min("seen").alias("first_seen"),
        F.max("seen").alias("last_seen"),
    )


def record_failures(quarantine: DataFrame, records: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Entries after a batch; ``became_poison`` marks those that just hit the limit."""
    fresh = quarantine_from(records)
    both = (
        quarantine.select(*QUARANTINE.names).withColumn("fresh", F.lit(0).cast("bigint"))
        .unionByName(fresh.withColumn("fresh", F.col("count")))
    )
    limit = cfg.poison_pill_max_failures
    return (
        both.groupBy("correlation_id")
        .agg(
            F.sum("count").alias("count"),
            F.max(F.struct("last_seen", "last_error"))["last_error"].alias("last_error"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
            F.sum("fresh").alias("fresh"),
        )
        .select(
            *QUARANTINE.names,
            ((F.col("count") >= limit) & (F.col("count") - F.col("fresh") < limit))
            .alias("became_poison"),
        )
    )


def clear(quarantine: DataFrame, repaired: DataFrame) -> DataFrame:
    """Entries without the repaired traces."""
    return quarantine.join(repaired.select("correlation_id"), "correlation_id", "left_anti")


def batch_failure_gate(failed: DataFrame, cfg: EngineConfig) -> DataFrame:
    count = F.count("*")
    return failed.agg(
        count.alias("failed"), (count >= cfg.circuit_breaker_threshold).alias("tripped")
    )
