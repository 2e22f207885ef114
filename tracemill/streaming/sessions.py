"""Sessions of a trace in event time: bursts of its rows with a pause between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracemill.functions import messages as M
from tracemill.session import apply_settings
from tracemill.streaming.history import arrived


def trace_sessions(logs: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """One row per session, once no row within ``delay`` of the latest one can extend it.

    Rows that come later than that are dropped, and what the state holds is dropped behind the
    watermark, so that it follows the traces that are active and not the age of the job. Partial
    sessions are merged before they are shuffled.
    """
    rank = M.level_rank(M.normalize_level(F.col("level")))
    session = F.session_window("timestamp", gap).alias("session")
    return (
        arrived(logs)
        .withWatermark("timestamp", delay)
        .groupBy("correlationId", session)
        .agg(F.count("*").alias("log_count"), F.count_if(rank >= M.ERROR_RANK).alias("errors"))
        .select("correlationId", "session.start", "session.end", "log_count", "errors")
    )


def run_sessions(logs: DataFrame, path: str, gap: str, delay: str, continuous: bool = False) -> StreamingQuery:
    """Append finished sessions to Parquet files under ``path``."""
    spark = apply_settings(logs.sparkSession)
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    writer = trace_sessions(logs, gap, delay).writeStream.outputMode("append").format("parquet").options(
        path=f"{path}/sessions", checkpointLocation=f"{path}/checkpoint"
    )
    return (writer if continuous else writer.trigger(availableNow=True)).start()
