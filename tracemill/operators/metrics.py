"""Counts per batch.

They are observed on the tables that a batch writes anyway, so that no job runs for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tracemill.config import EngineConfig
from tracemill.operators.gate import INSERT
from tracemill.operators.traces import SKIPPED

COUNTS = ("promoted", "dropped", "failed", "total")


def observed_traces(traces: DataFrame, observation: Observation) -> DataFrame:
    """``traces``, counted by error while they pass."""
    return traces.observe(
        observation, F.count_if(F.col("error") == SKIPPED).alias("skipped"),
        F.count_if(F.col("error") != SKIPPED).alias("failed"),
    )


def observed_verdicts(verdicts: DataFrame, observation: Observation) -> DataFrame:
    """``verdicts``, counted by what they do to the store; repeats count as dropped."""
    return verdicts.observe(
        observation, F.count_if(F.col("operation") == INSERT).alias("promoted"), F.count("*").alias("decided")
    )


def counted(observed: tuple[Observation, Observation], cfg: EngineConfig) -> dict:
    """Promoted, dropped and failed traces, all of them with the skipped ones, and whether the batch halts."""
    seen = {name: n or 0 for observation in observed for name, n in observation.get.items()}
    promoted, failed, decided = (seen.get(name, 0) for name in ("promoted", "failed", "decided"))
    return {
        "promoted": promoted, "dropped": decided - promoted, "failed": failed,
        "total": decided + failed + seen.get("skipped", 0),
        "tripped": failed >= cfg.circuit_breaker_threshold,
    }


def metrics_row(spark: SparkSession, counts: dict) -> DataFrame:
    numbers = [F.lit(counts[name]).cast("bigint").alias(name) for name in COUNTS]
    return spark.range(1).select(*numbers, F.lit(counts["tripped"]).alias("tripped"))


def promotion_rate(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("action", "tier").agg(F.count("*").alias("n"))
