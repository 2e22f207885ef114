"""One batch, from canonical rows to the next state."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tracemill.config import EngineConfig
from tracemill.operators import documents as D
from tracemill.operators import gate as G
from tracemill.operators import quarantine as Q
from tracemill.operators.embed import embed_documents
from tracemill.operators.rows import unpacked
from tracemill.operators.metrics import counted, metrics_row, observed_traces, observed_verdicts
from tracemill.operators.traces import SKIPPED, failed_traces, trace_features, valid_traces
from tracemill.session import staged

Stage = Callable[[DataFrame, str], DataFrame]


def prepare_documents(rows: DataFrame, cfg: EngineConfig | None = None) -> DataFrame:
    """Gate-free mode: a document for every valid trace."""
    cfg = cfg or EngineConfig.standalone()
    return D.trace_documents(valid_traces(trace_features(rows, cfg)), rows, cfg)


@dataclass(frozen=True)
class BatchOutcome:
    """Results of a batch. Each is planned when it is first asked for."""

    rows: DataFrame
    kept: DataFrame
    quarantined: DataFrame
    traces: DataFrame
    observed: tuple[Observation, Observation]
    pairs: DataFrame
    decided: DataFrame
    as_of: int
    cfg: EngineConfig
    load_encoder: Callable | None
    stage: Stage

    @cached_property
    def usable(self) -> DataFrame:
        return Q.skip_poison(self.rows, self.quarantined, self.cfg)

    @cached_property
    def features(self) -> DataFrame:
        """All features of all traces, valid or not."""
        return trace_features(self.usable, self.cfg)

    @cached_property
    def verdicts(self) -> DataFrame:
        return G.explain_new(self.decided, self.pairs, self.stage)

    @cached_property
    def removed(self) -> DataFrame:
        """Keys of the documents that re-evaluated traces replace."""
        return valid_traces(self.traces).where("is_merge").select(*D.DOCUMENT_KEY)

    @cached_property
    def new_documents(self) -> DataFrame:
        """Documents of the inserted traces.

        Most traces are dropped or are repeats, so this second pass over the
        rows takes those of the inserted traces alone.
        """
        inserted = D.inserted_only(self.decided)
        wanted = self.stage(unpacked(D.rows_of(self.usable, inserted)), "rows")
        fresh = D.trace_documents(
            valid_traces(trace_features(wanted, self.cfg)), wanted, self.cfg
        )
        return D.checked_documents(
            embed_documents(fresh, self.cfg, self.load_encoder), self.cfg
        )

    @cached_property
    def repeats(self) -> DataFrame:
        return D.repeats(self.decided, self.as_of)

    @cached_property
    def documents(self) -> DataFrame:
        """The stored documents after the batch."""
        return D.increment_occurrence(D.upsert(self.kept, self.new_documents), self.repeats)

    @cached_property
    def failures(self) -> DataFrame:
        return Q.failures(failed_traces(self.traces), self.as_of)

    @cached_property
    def quarantine(self) -> DataFrame:
        """The quarantine after the batch."""
        return Q.record_failures(self.quarantined, self.failures, self.cfg)

    @cached_property
    def counts(self) -> dict:
        """Traces by what became of them, as the passes that wrote them counted."""
        return counted(self.observed, self.cfg)

    @cached_property
    def metrics(self) -> DataFrame:
        return metrics_row(self.rows.sparkSession, self.counts)


def skipped_traces(rows: DataFrame, trace_ids: DataFrame | None, quarantine: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Poisoned traces of the batch, as traces with an error of their own."""
    ids = rows.select("correlation_id") if trace_ids is None else trace_ids
    found = ids.join(Q.poisoned(quarantine, cfg), "correlation_id", "left_semi").distinct()
    return found.withColumn("error", F.lit(SKIPPED))


def run_batch(
    rows: DataFrame,
    documents: DataFrame,
    commits: DataFrame,
    quarantine: DataFrame,
    as_of: int,
    cfg: EngineConfig = EngineConfig(),
    load_encoder: Callable | None = None,
    stage: Stage = staged,
    trace_ids: DataFrame | None = None,
) -> BatchOutcome:
    """Evaluate canonical rows, or packed ones (see ``operators.rows.packed_rows``), against the stored documents.

    The first pass over the rows keeps only what verdicts need. Staged tables
    feed several outputs each, and are counted while they are written. ``trace_ids``
    may name the correlation IDs of the batch where they are at hand already.
    """
    usable = Q.skip_poison(rows, quarantine, cfg)
    traces_seen, verdicts_seen = Observation(), Observation()
    features = G.gate_inputs(trace_features(usable, cfg))
    skipped = skipped_traces(rows, trace_ids, quarantine, cfg)
    judged = stage(
        observed_traces(features.unionByName(skipped, allowMissingColumns=True), traces_seen), "traces"
    )
    valid = valid_traces(judged)
    kept = D.delete_by_cid(documents, valid.where("is_merge"))
    traces = G.candidates(valid, commits, as_of, cfg, stage)
    moments, pairs = G.history(traces, kept, cfg, stage)
    decided = stage(observed_verdicts(G.evaluate(traces, moments, cfg), verdicts_seen), "verdicts")
    return BatchOutcome(
        rows, kept, quarantine, judged, (traces_seen, verdicts_seen), pairs, decided, as_of, cfg,
        load_encoder, stage,
    )
