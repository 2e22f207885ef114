"""The continuous job: logs in, state tables out."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracemill import schemas as S
from tracemill.config import EngineConfig
from tracemill.operators.quarantine import quarantine_from
from tracemill.operators.rows import flat_rows, packed_rows, unpacked
from tracemill.plans.batch import run_batch
from tracemill.session import Staging, apply_settings
from tracemill.sources.logs import batch_row_counts, by_project
from tracemill.streaming import history
from tracemill.streaming.history import arrived
from tracemill.streaming.store import TraceStore


class BatchHalted(RuntimeError):
    """Too many traces of a batch failed; the batch is retried on the next start."""


def process_batch(
    store: TraceStore,
    rows: DataFrame,
    batch_id: int,
    commits: DataFrame,
    as_of: int,
    cfg: EngineConfig = EngineConfig(),
    load_encoder: Callable | None = None,
    halt_on_failures: bool = True,
) -> None:
    """Evaluate one micro-batch against everything before it and write its tables.

    ``rows`` are log rows, or the histories of the traces they touch (see ``history.touched``).
    Where log rows include earlier ones, ``in_batch`` tells the new ones; without that column all
    are new. A batch with too many failed traces halts and advances nothing. ``as_of``
    holds for the first attempt of a batch; later attempts and replays use the same time.
    """
    staging = Staging(store.spark)
    try:
        _process(store, rows, batch_id, commits, store.as_of(batch_id, as_of), cfg, load_encoder,
                 halt_on_failures, staging)
    finally:
        staging.clear()


def _process(store, rows, batch_id, commits, as_of, cfg, load_encoder, halt_on_failures, staging) -> None:
    histories = "items" in rows.columns
    if not histories and "in_batch" not in rows.columns:
        rows = arrived(rows).withColumn("in_batch", F.lit(True))
    # Written once: reading the stream's own rows again would run its stateful part again.
    touched = staging(rows, "touched")
    if histories:
        own = touched.select("correlationId", F.col("own").alias("n"))
        parts = own if history.APPENDED == 1 else own.groupBy("correlationId").agg(F.sum("n").alias("n"))
        store.write("seen", batch_id, parts.where("n > 0"))
        packed = packed_rows(touched, as_of)
        # A trace in several lists is folded from its rows.
        canonical = packed if history.APPENDED == 1 else unpacked(packed)
    else:
        store.write("seen", batch_id, batch_row_counts(touched.where("in_batch")))
        canonical = flat_rows(touched, as_of)

    outcome = run_batch(
        canonical,
        store.live_documents(before=batch_id).select(*S.DOCUMENTS.names),
        commits,
        quarantine_from(store.failures(batch_id)),
        as_of,
        cfg,
        load_encoder,
        stage=staging,
        trace_ids=store.batch("seen", batch_id).select(
            F.col("correlationId").alias("correlation_id")
        ),
    )
    if halt_on_failures and outcome.counts["tripped"]:
        # Each halted attempt counts, so traces that keep failing end up skipped.
        attempt = store.halted_attempts(batch_id) + 1
        store.write("failures", batch_id, outcome.failures, attempt)
        raise BatchHalted(f"batch {batch_id}: {cfg.circuit_breaker_threshold} or more failed traces")
    store.write("failures", batch_id, outcome.failures)
    store.write("documents", batch_id, outcome.new_documents)
    store.write("removed", batch_id, outcome.removed)
    store.write("repeats", batch_id, outcome.repeats)
    store.write("metrics", batch_id, outcome.metrics)


def run_stream(
    logs: DataFrame,
    store: TraceStore,
    commits: Callable[[], DataFrame],
    cfg: EngineConfig = EngineConfig(),
    as_of: Callable[[int], int] | None = None,
    continuous: bool = False,
    load_encoder: Callable | None = None,
    halt_on_failures: bool = True,
) -> StreamingQuery:
    """Start the job on a streaming log table (see ``sources.logs.stream_logs``).

    By default it drains what is available at the start and stops; with
    ``continuous`` it wakes up every ``fetch_interval_minutes``. Either way the source's
    admission limits cut what is there into bounded micro-batches. The checkpoint
    under the store is the resume point.
    """
    store.create()
    apply_settings(store.spark)
    logs = by_project(logs) if cfg.group_by_project else logs
    clock = as_of or (lambda batch_id: int(time.time()))

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(
            store, batch, batch_id, commits(), clock(batch_id), cfg, load_encoder, halt_on_failures
        )

    writer = history.touched(logs).writeStream.outputMode("update").foreachBatch(handle).option(
        "checkpointLocation", store.checkpoint
    )
    if continuous:
        return writer.trigger(processingTime=f"{cfg.fetch_interval_minutes} minutes").start()
    return writer.trigger(availableNow=True).start()
