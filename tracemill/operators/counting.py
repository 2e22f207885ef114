"""Counting what came before a moment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.operators.ranges import Stage, running

# Entries older than this were there from the start (see gate.always).
FROM_THE_START = "0002-01-01 00:00:00"


def count_before(
    probes: DataFrame, entries: DataFrame, keys: list[str], at: str, stage: Stage
) -> DataFrame:
    """``known``: entries of the same key whose moment is before the probe's.

    Probes and entries are one sorted table, and what is known is a running total over its
    ranges, so that a busy key is spread over many of them.
    """
    starts_at = F.col(f"{at}.entered_at")
    from_start = starts_at < F.lit(FROM_THE_START).cast("timestamp")
    base = entries.where(from_start).groupBy(*keys).agg(F.count("*").alias("base"))
    moment = F.struct("entered_at", "correlation_id")
    timeline = (
        probes.select(*keys, "correlation_id", moment.alias("at"), F.lit(0).alias("entry"))
        .unionByName(
            entries.where(~from_start).select(
                *keys, F.lit(None).cast("string").alias("correlation_id"),
                F.col(at).alias("at"), F.lit(1).alias("entry"),
            )
        )
    )
    # On equal moments the probe (entry = 0) stands first: only earlier entries count.
    counted = running(timeline, keys, ["at", "entry"], stage, {"before": F.col("entry")}).where("entry = 0")
    return counted.join(base, keys, "left").select(
        *keys, "correlation_id", (F.col("before") + F.coalesce("base", F.lit(0))).alias("known")
    )
