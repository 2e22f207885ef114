"""Registered queries: each operator over the log rows derived from ``events``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import fixtures
from catalog.fixtures import AS_OF
from catalog.oracle import MID_DAY, SLICE_AFTER, SLICE_ROWS, SLICE_UPTO
from tracemill import schemas as S
from tracemill.config import EngineConfig
from tracemill.functions import messages as M
from tracemill.functions import text as X
from tracemill.functions import traces as TR
from tracemill.operators import buckets as B
from tracemill.operators import documents as D
from tracemill.operators import gate as G
from tracemill.operators import quarantine as Q
from tracemill.operators import rows as R
from tracemill.operators import traces as O
from tracemill.operators.metrics import promotion_rate
from tracemill.plans.batch import BatchOutcome, prepare_documents, run_batch
from tracemill.session import apply_settings, delete_folder, shared_dir, staged
from tracemill.sources import logs as L
from tracemill.streaming.history import stored_rows
from tracemill.streaming.ingest import BatchHalted, process_batch, run_stream
from tracemill.streaming.nested import NestedStore, run_nested, stream_raw_traces
from tracemill.streaming.sessions import run_sessions
from tracemill.streaming.store import TraceStore

Query = Callable[[SparkSession, str], DataFrame]
CFG = EngineConfig()
# The fixture holds more failed traces than a batch may have by default.
STREAM_CFG = replace(CFG, circuit_breaker_threshold=10**9)


# ---- inputs ----------------------------------------------------------------


def logs(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.logs(spark, sf)


def rows(spark: SparkSession, sf: str) -> DataFrame:
    return R.flat_rows(logs(spark, sf), AS_OF)


def early(df: DataFrame) -> DataFrame:
    return df.where(F.col("timestamp") <= F.lit(MID_DAY).cast("timestamp_ntz"))


def late(df: DataFrame) -> DataFrame:
    return df.where(F.col("timestamp") > F.lit(MID_DAY).cast("timestamp_ntz"))


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return O.valid_traces(O.trace_features(rows(spark, sf), CFG))


def window(spark: SparkSession, sf: str) -> DataFrame:
    """Everything between two marks."""
    return L.incremental_filter(logs(spark, sf), SLICE_AFTER, SLICE_UPTO)


def cut(spark: SparkSession, sf: str) -> DataFrame:
    """The polling slice used by the slice operators."""
    return L.batch_slice(window(spark, sf), SLICE_ROWS)


def failed(spark: SparkSession, sf: str) -> DataFrame:
    return O.failed_traces(O.trace_features(rows(spark, sf), CFG))


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Failures of the early rows seen twice, then those of all rows."""
    before = O.failed_traces(O.trace_features(R.flat_rows(early(logs(spark, sf)), AS_OF), CFG))
    twice = Q.failures(before, AS_OF - 7200).unionByName(Q.failures(before, AS_OF - 3600))
    return Q.record_failures(
        Q.quarantine_from(twice), Q.failures(failed(spark, sf), AS_OF), CFG
    )


def raw_files(spark: SparkSession, sf: str) -> str:
    """The log rows as nested traces, in JSON lines."""
    request = F.when(
        R.has_request(F.col("requestMethod"), F.col("requestPath")),
        F.struct(F.col("requestMethod").alias("method"), F.col("requestPath").alias("path"),
                 F.col("statusCode").cast("string").alias("statusCode")),
    )
    context = F.struct(
        "timestamp", "rowSeq", "projectId", "loggerName", "sessionStartedAt", "durationMs",
        request.alias("request"),
    )
    entry = F.struct(
        "timestamp", "rowSeq", "level", "message",
        F.when(~F.startswith("meta", F.lit("not")), F.col("meta")).alias("meta"),
        F.col("loggerName").alias("loggername"), "exception",
    )
    nested = logs(spark, sf).groupBy("correlationId").agg(
        F.min(context).alias("c"), F.array_sort(F.collect_list(entry)).alias("entries")
    )
    entries = F.transform("entries", lambda e: F.struct(
        e["timestamp"].cast("string").alias("timestamp"), e["level"].alias("level"),
        e["message"].alias("message"), e["meta"].alias("meta"),
        e["loggername"].alias("loggername"), e["exception"].alias("exception"),
    ))
    traces = nested.select(
        F.col("c.projectId").alias("projectName"), F.col("c.projectId").alias("project_id"),
        F.lit("").alias("environment"), "correlationId",
        F.col("c.loggerName").alias("component"),
        F.col("c.sessionStartedAt").cast("string").alias("startedAt"),
        F.lit(None).cast("string").alias("endedAt"),
        F.col("c.durationMs").cast("string").alias("durationMs"),
        F.col("c.request").alias("request"), entries.alias("logs"),
    )
    path = f"{shared_dir(spark)}/raw/{uuid.uuid4().hex}"
    traces.write.json(path)
    return path


def raw_traces(spark: SparkSession, sf: str) -> DataFrame:
    return L.scan_raw_traces(spark, raw_files(spark, sf))


def evaluate(
    spark: SparkSession, sf: str, canonical: DataFrame, documents: DataFrame | None = None
) -> BatchOutcome:
    stored = documents if documents is not None else S.empty_table(spark, S.DOCUMENTS)
    return run_batch(
        canonical, stored, fixtures.commits(spark, sf), S.empty_table(spark, S.QUARANTINE), AS_OF, CFG
    )


def whole(spark: SparkSession, sf: str) -> BatchOutcome:
    return evaluate(spark, sf, rows(spark, sf))


def store_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/documents/{uuid.uuid4().hex}"


def stored_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The store as the early rows leave it."""
    outcome = evaluate(spark, sf, R.flat_rows(early(logs(spark, sf)), AS_OF))
    path = D.write_documents(outcome.documents, store_path(spark))
    return D.read_documents(spark, path)


def second_rows(spark: SparkSession, sf: str) -> DataFrame:
    table = logs(spark, sf)
    return R.flat_rows(L.refetch_partial_traces(late(table), table), AS_OF)


def second(spark: SparkSession, sf: str) -> BatchOutcome:
    return evaluate(spark, sf, second_rows(spark, sf), stored_documents(spark, sf))


def kept_documents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Valid traces of the second batch, and the store without those it replaces."""
    features = G.gate_inputs(O.trace_features(second_rows(spark, sf), CFG))
    traces = O.valid_traces(staged(features, "features"))
    merged = traces.where("is_merge")
    return traces, D.delete_by_cid(stored_documents(spark, sf), merged)


# ---- output shapes ---------------------------------------------------------


def text(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def number(name: str):
    return F.coalesce(F.col(name), F.lit(-1)).cast("bigint").alias(name)


def listed(name: str, separator: str = "|"):
    return F.coalesce(F.array_join(name, separator), F.lit("")).alias(name)


def renamed(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def documents_view(df: DataFrame) -> DataFrame:
    return df.select(
        "project_id", "correlation_id", "project_name", "fingerprint", "semantic_text",
        text("request_method"), text("request_path"), text("request_path_pattern"),
        number("request_status_code"), listed("services", " > "), "max_level", "outcome",
        number("severity_score"), "has_errors", "has_warnings", "log_count",
        listed("levels_present"), "environment", number("duration_ms"), "timestamp_unix",
        listed("error_types"), listed("suspicious_keywords"), "occurrence_count", "last_seen",
        F.unix_micros("entered_at").alias("entered_us"), F.size("embedding").cast("bigint").alias("dimensions"),
    )


def tier_view(verdicts: DataFrame, prefix: str) -> DataFrame:
    return verdicts.where(F.col("tier").startswith(prefix)).select(
        "correlation_id", "project_id", "tier", "operation"
    )


def ids(df: DataFrame, *more: str) -> DataFrame:
    return renamed(df, row_seq="rowSeq", correlation_id="correlationId", **{m: m for m in more})


# ---- sources ---------------------------------------------------------------


def scan_logs(spark, sf):
    """The log table read back from the files it was written to."""
    path = f"{shared_dir(spark)}/logs/{uuid.uuid4().hex}"
    as_logs(logs(spark, sf)).write.parquet(path)
    return L.scan_logs(spark, path).select(
        F.col("rowSeq").alias("row_seq"), F.col("projectId").alias("project_id"),
        F.col("correlationId").alias("correlation_id"),
        F.unix_micros(F.col("timestamp").cast("timestamp")).alias("ts_us"),
        "level", F.col("loggerName").alias("logger_name"), "message", text("meta"),
        F.col("durationMs").alias("duration_ms"),
    )


def incremental_filter(spark, sf):
    found = window(spark, sf)
    return ids(found.withColumn("ts_us", F.unix_micros(F.col("timestamp").cast("timestamp"))), "ts_us")


def batch_slice(spark, sf):
    return ids(cut(spark, sf))


def trim_split_tail(spark, sf):
    return ids(L.trim_split_tail(cut(spark, sf), SLICE_ROWS))


def fetch_cid(spark, sf):
    return ids(L.rows_of_traces(logs(spark, sf), window(spark, sf)))


def latest_commit(spark, sf):
    per_project = logs(spark, sf).groupBy(F.col("projectId").alias("project_id")).agg(
        F.count("*").alias("log_rows")
    )
    path = f"{shared_dir(spark)}/commits/{uuid.uuid4().hex}"
    fixtures.commits(spark, sf).write.parquet(path)
    newest = L.latest_commit(L.scan_commits(spark, path))
    return per_project.join(newest, "project_id", "left").select(
        "project_id", "log_rows",
        F.coalesce("timestamp_unix", F.lit(0)).cast("bigint").alias("latest_commit"),
    )


def read_documents(spark, sf):
    """One project of the store, read by its partition; a missing store adds nothing."""
    outcome = evaluate(spark, sf, R.flat_rows(early(logs(spark, sf)), AS_OF))
    path = D.write_documents(outcome.documents, store_path(spark))
    missing = D.read_documents(spark, store_path(spark), project="proj-1")
    return D.read_documents(spark, path, project="proj-1").unionByName(missing).select(
        "correlation_id", "fingerprint"
    )


def mark(df: DataFrame) -> DataFrame:
    return df.select(F.unix_micros(F.col("mark").cast("timestamp")).alias("mark_us"))


def high_water_mark(spark, sf):
    return mark(L.high_water_mark(window(spark, sf), SLICE_AFTER))


def safe_high_water_mark(spark, sf):
    bad = renamed(failed(spark, sf), correlationId="correlation_id")
    return mark(L.safe_high_water_mark(window(spark, sf), SLICE_AFTER, bad))


def process_one_trace(spark, sf):
    canonical = R.nested_rows(raw_traces(spark, sf), AS_OF)
    return prepare_documents(canonical).select(
        "correlation_id", "fingerprint", "semantic_text", listed("suspicious_keywords"), "log_count"
    )


# ---- state -----------------------------------------------------------------


def upsert_documents(spark, sf):
    """The store after two batches, written and read back."""
    path = D.write_documents(second(spark, sf).documents, store_path(spark))
    return documents_view(D.read_documents(spark, path))


def delete_by_cid(spark, sf):
    return kept_documents(spark, sf)[1].select("project_id", "correlation_id", "fingerprint")


def increment_occurrence(spark, sf):
    return documents_view(whole(spark, sf).documents)


def batch_metrics(spark, sf):
    return whole(spark, sf).metrics


def quarantine_record(spark, sf):
    return quarantine(spark, sf).select(
        "correlation_id", "count", "last_error",
        F.unix_seconds("first_seen").alias("first_seen"),
        F.unix_seconds("last_seen").alias("last_seen"), "became_poison",
    )


def quarantine_clear(spark, sf):
    entries = staged(quarantine(spark, sf), "quarantine")
    repaired = entries.where("last_error = 'invalid_meta'")
    return Q.clear(entries, repaired).select("correlation_id", "count")


def documents_schema(spark, sf):
    return whole(spark, sf).new_documents.select(
        "correlation_id", F.size("embedding").cast("bigint").alias("dimensions")
    )


def batch_failure_gate(spark, sf):
    return Q.batch_failure_gate(failed(spark, sf), CFG)


# ---- rows ------------------------------------------------------------------


def parse_meta(spark, sf):
    parsed = logs(spark, sf).withColumn("map", R.parse_json_column(F.col("meta")))
    return parsed.select(
        F.col("rowSeq").alias("row_seq"),
        F.coalesce(F.array_join(F.map_keys("map"), "|"), F.lit("")).alias("keys"),
        F.coalesce(M.python_text(F.col("map")["k"]), F.lit("")).alias("k"),
        F.coalesce(R.is_json_non_object(F.col("meta")), F.lit(False)).alias("invalid"),
    )


def parse_exception(spark, sf):
    carried = logs(spark, sf).withColumn("exception", F.col("meta")).withColumn(
        "meta", F.lit(None).cast("string")
    )
    bad = R.ROW_ERRORS["invalid_exception"]
    return R.flat_rows(carried, AS_OF).select(
        "row_seq",
        F.coalesce(M.python_text(R.parse_json_column(F.col("exception"))["order"]), F.lit(""))
        .alias("ord"),
        (F.col("error_bits").bitwiseAND(bad) != 0).alias("invalid"),
    )


def normalize_level(spark, sf):
    return rows(spark, sf).select("row_seq", text("level"), number("level_rank"))


def validate_trace(spark, sf):
    return O.validate_traces(rows(spark, sf)).select("correlation_id", text("error"))


def validate_gaps(spark, sf):
    """Traces whose rows lack fields or hold unreadable ones."""
    seq = F.col("rowSeq")
    gappy = logs(spark, sf).withColumns({
        "level": F.when(seq % 101 != 1, F.col("level")),
        "message": F.when(seq % 103 != 2, F.col("message")),
        "loggerName": F.when(seq % 107 != 3, F.col("loggerName")),
        "exception": F.when(seq % 109 == 4, F.lit("[1, 2]")).when(seq % 2 == 0, F.lit('{"type": "E"}')),
        "sessionEndedAt": F.when(seq % 3 == 0, F.col("timestamp").cast("timestamp")),
    })
    canonical = R.flat_rows(gappy, AS_OF)
    context = O.first_row_context(canonical).select("correlation_id", text("ended_at"))
    return O.validate_traces(canonical).join(context, "correlation_id").select(
        "correlation_id", text("error"), "ended_at"
    )


def build_request(spark, sf):
    return rows(spark, sf).select(
        "row_seq", text("request_method").alias("method"), text("request_path").alias("path"),
        number("request_status_code").alias("status"),
    )


def trace_context(spark, sf):
    return O.first_row_context(rows(spark, sf)).select(
        "correlation_id", "project_id", "project_name", "environment", "component", "started_at"
    )


def log_defaults(spark, sf):
    bare = logs(spark, sf).drop("level", "message", "projectId")
    return R.flat_rows(bare, AS_OF).select("row_seq", "level", "message", "logger_name")


def resolve_service(spark, sf):
    return O.with_service(rows(spark, sf)).select("row_seq", "service")


def normalize_timestamp(spark, sf):
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    suffix = F.when(F.col("rowSeq") % 2 == 0, "Z").otherwise("")
    as_text = F.when(F.col("rowSeq") % 17 == 0, "not a time").otherwise(F.concat(stamp, suffix))
    return R.flat_rows(logs(spark, sf).withColumn("timestamp", as_text), AS_OF).select(
        "row_seq", R.iso_text(F.col("ls_ts")).alias("iso"),
        F.col("ls_ts_unix").alias("unix_seconds"), "ts_valid",
    )


def request_context(spark, sf):
    return O.first_row_context(rows(spark, sf)).select(
        "correlation_id", text("request_method"), text("request_path"),
        number("request_status_code"),
    )


def flatten_trace(spark, sf):
    return R.nested_rows(raw_traces(spark, sf), AS_OF).select(
        "correlation_id", "row_seq", "message", "level"
    )


def skip_empty_traces(spark, sf):
    is_even = F.day(F.element_at("logs", 1)["timestamp"].cast("timestamp")) % 2 == 0
    emptied = raw_traces(spark, sf).withColumn(
        "logs", F.when(is_even, F.col("logs")).otherwise(F.slice("logs", 1, 0))
    )
    return R.nested_rows(emptied, AS_OF).groupBy("correlation_id").agg(
        F.count("*").alias("log_count")
    )


def skip_poison(spark, sf):
    usable = Q.skip_poison(rows(spark, sf), quarantine(spark, sf), CFG)
    return usable.groupBy("correlation_id").agg(F.count("*").alias("n"))


def promoted_only(spark, sf):
    return G.promoted_only(whole(spark, sf).verdicts).select("correlation_id", "tier")


def dropped_only(spark, sf):
    return G.dropped_only(whole(spark, sf).verdicts).select("correlation_id", "tier")


# ---- lookups ---------------------------------------------------------------


def detect_partial_traces(spark, sf):
    table = logs(spark, sf)
    return renamed(
        L.partial_traces(late(table), table), correlation_id="correlationId", n="n", total="total"
    )


def refetch_without_order(spark, sf):
    """Heartbeats: a source without row numbers that repeats its lines, some at one time."""
    beats = as_logs(logs(spark, sf)).withColumns({
        "level": F.lit("INFO"), "message": F.lit("heartbeat ok"), "meta": F.lit(None).cast("string"),
    })
    table = beats.unionByName(beats.where("rowSeq % 3 = 0")).drop("rowSeq")
    boundary = F.lit(MID_DAY).cast("timestamp")
    found = L.refetch_partial_traces(table.where(F.col("timestamp") > boundary), table)
    return R.flat_rows(found, AS_OF).groupBy("correlation_id").agg(
        F.count("*").alias("log_count"), F.count_if("in_batch").alias("in_batch")
    )


def refetch_partial_traces(spark, sf):
    return second_rows(spark, sf).groupBy("correlation_id").agg(
        F.count("*").alias("log_count"), (~F.bool_and("in_batch")).alias("is_merge")
    )


def fingerprint_exists(spark, sf):
    traces, kept = kept_documents(spark, sf)
    stored = G.stored_fingerprints(kept)
    return traces.join(stored, ["project_id", "fingerprint"], "left").select(
        "correlation_id", F.col("keeper").isNotNull().alias("is_stored")
    )


def fingerprint_buckets(spark, sf):
    """Fingerprints of the second batch against a store in buckets, registered again as a new session would."""
    name, path = f"documents_{uuid.uuid4().hex}", store_path(spark)
    B.write_buckets(stored_documents(spark, sf), name, path, 16)
    spark.sql(f"DROP TABLE {name}")
    stored = G.stored_fingerprints(B.open_buckets(spark, name, path, 16))
    traces = O.valid_traces(O.trace_features(second_rows(spark, sf), CFG))
    return traces.join(stored, ["project_id", "fingerprint"], "left").select(
        "correlation_id", F.coalesce("keeper", F.lit("")).alias("keeper")
    )


def known_fingerprints(spark, sf):
    return renamed(
        G.known_fingerprints(stored_documents(spark, sf)),
        project_id="project_id", request_path_pattern="path_key", fingerprint="fingerprint",
    )


def deploy_window_join(spark, sf):
    traces = G.candidates(valid(spark, sf), fixtures.commits(spark, sf), AS_OF, CFG)
    return traces.select("correlation_id", "in_deploy")


def deploy_as_of_trace(spark, sf):
    """The latest commit at or before each trace, with many commits per project."""
    traces = valid(spark, sf).select("project_id", "correlation_id", "entered_at")
    cfg = replace(CFG, deploy_window_minutes=600)
    return G.deployed_traces(traces, fixtures.commit_history(spark, sf), cfg).select(
        "correlation_id", F.coalesce("latest_commit", F.lit(-1)).cast("bigint").alias("latest_commit"), "in_deploy"
    )


def dedup_split(spark, sf):
    return G.promoted_only(second(spark, sf).verdicts).select("correlation_id", "operation")


# ---- aggregates ------------------------------------------------------------


def reassemble_traces(spark, sf):
    return O.reassemble_traces(rows(spark, sf)).select(
        "correlation_id", "project_id", "component", "log_count",
        F.unix_micros("first_ts").alias("first_us"), F.unix_micros("last_ts").alias("last_us"),
        "first_message", "last_message",
    )


def first_row_context(spark, sf):
    return O.first_row_context(rows(spark, sf)).select(
        "correlation_id", "project_id", text("request_method"), text("request_path"), "duration_ms"
    )


def bulk_count_cids(spark, sf):
    counts = L.total_row_counts(logs(spark, sf), window(spark, sf))
    return renamed(counts, correlation_id="correlationId", n="n")


def batch_row_counts(spark, sf):
    return renamed(L.batch_row_counts(window(spark, sf)), correlation_id="correlationId", n="n")


def chronological_logs(spark, sf):
    return O.chronological_logs(rows(spark, sf)).select("correlation_id", "row_seq", "position")


def tied_positions(spark, sf):
    """Traces of a third of all rows each, half of whose rows share one instant."""
    half = F.col("rowSeq") % 2 == 0
    long = logs(spark, sf).withColumns({
        "correlationId": F.col("projectId"),
        "timestamp": F.when(half, F.lit(MID_DAY).cast("timestamp_ntz")).otherwise(F.col("timestamp")),
    })
    return O.chronological_logs(R.flat_rows(long, AS_OF)).select("correlation_id", "row_seq", "position")


def services_in_order(spark, sf):
    return O.services_in_order(rows(spark, sf)).select("correlation_id", listed("services", " > "))


def max_level(spark, sf):
    return O.level_features(rows(spark, sf)).select("correlation_id", "max_level")


def levels_present(spark, sf):
    return O.level_features(rows(spark, sf)).select("correlation_id", listed("levels_present"))


def error_flags(spark, sf):
    return O.level_features(rows(spark, sf)).select("correlation_id", "has_errors", "has_warnings")


def log_count(spark, sf):
    return O.level_features(rows(spark, sf)).select("correlation_id", "log_count")


def error_types(spark, sf):
    return O.error_types(rows(spark, sf), CFG).select("correlation_id", listed("error_types"))


def detect_suspicious_keywords(spark, sf):
    return O.suspicious_keywords(rows(spark, sf), CFG).select(
        "correlation_id", listed("suspicious_keywords")
    )


def fingerprint_message(spark, sf):
    return O.fingerprint_message(rows(spark, sf), CFG)


def occurrence_counts(spark, sf):
    return D.occurrence_counts(whole(spark, sf).verdicts)


def promotion_rates(spark, sf):
    return promotion_rate(whole(spark, sf).verdicts)


def enrich_trace(spark, sf):
    return valid(spark, sf).select(
        "correlation_id", "project_id", listed("services", " > "), "max_level", "outcome",
        number("severity_score"), "fingerprint", listed("error_types"),
        listed("suspicious_keywords"), text("request_path_pattern"), listed("levels_present"),
        "has_errors", "has_warnings", "log_count",
    )


# ---- gate ------------------------------------------------------------------


def gate_severity(spark, sf):
    tier = G.severity_tier(CFG).alias("tier")
    return valid(spark, sf).select("correlation_id", tier).where("tier IS NOT NULL")


def gate_content(spark, sf):
    remaining = valid(spark, sf).where(G.severity_tier(CFG).isNull())
    return remaining.select("correlation_id", G.content_tier().alias("tier")).where(
        "tier IS NOT NULL"
    )


def gate_cold_start(spark, sf):
    return tier_view(whole(spark, sf).verdicts, "tier5")


def gate_deploy_window(spark, sf):
    return tier_view(second(spark, sf).verdicts, "tier2")


def gate_new_fingerprint(spark, sf):
    return tier_view(second(spark, sf).verdicts, "tier3")


def gate_default(spark, sf):
    return tier_view(second(spark, sf).verdicts, "default")


def gatekeeper(spark, sf):
    features = staged(G.gate_inputs(O.trace_features(rows(spark, sf), CFG)), "features")
    verdicts = G.gatekeeper(
        O.valid_traces(features), S.empty_table(spark, S.DOCUMENTS), fixtures.commits(spark, sf), AS_OF, CFG
    )
    return verdicts.select("correlation_id", "project_id", "action", "tier", "operation")


def gatekeeper_without_store(spark, sf):
    """Only the tiers that need no history."""
    return G.own_verdicts(valid(spark, sf), CFG).select("correlation_id", "action", "tier", "reason")


def gatekeeper_with_store(spark, sf):
    return tier_view(second(spark, sf).verdicts, "")


def verdict(spark, sf):
    return second(spark, sf).verdicts.select(
        "correlation_id", "action", "tier", "reason",
        (F.col("action") == G.PROMOTE).alias("is_promote"),
    )


# ---- scalar functions ------------------------------------------------------


def normalize_message(spark, sf):
    return rows(spark, sf).select(
        "row_seq", M.normalize_message(F.col("message")).alias("template")
    )


def extract_error_type(spark, sf):
    found = M.extract_error_type(
        F.col("message"), F.col("meta"), CFG.error_prefix_chars
    ).alias("error_type")
    return rows(spark, sf).select("row_seq", found).select("row_seq", text("error_type"))


def has_suspicious_keywords(spark, sf):
    hit = M.contains_any("lowered", CFG.suspicious_keywords)
    return rows(spark, sf).select("row_seq", hit.alias("suspicious"))


def classify_outcome(spark, sf):
    return valid(spark, sf).select("correlation_id", "outcome")


def trace_severity(spark, sf):
    return valid(spark, sf).select("correlation_id", number("severity_score"))


def normalize_request_path(spark, sf):
    contexts = O.first_row_context(rows(spark, sf))
    pattern = TR.normalize_request_path(F.col("request_path")).alias("pattern")
    return (
        contexts.select("request_path", pattern)
        .groupBy("request_path", "pattern")
        .agg(F.count("*").alias("n"))
        .select(text("request_path"), text("pattern"), "n")
    )


def trace_fingerprint(spark, sf):
    return valid(spark, sf).select("correlation_id", "fingerprint")


def normalize_for_dedup(spark, sf):
    return rows(spark, sf).select(
        "row_seq", M.normalize_for_dedup(F.col("message")).alias("norm")
    )


def http_operation(spark, sf):
    operation = X.http_operation(
        F.col("request_method"), F.col("request_path_pattern"), F.col("request_path"),
        F.col("duration_ms"),
    )
    return valid(spark, sf).select(
        "correlation_id", F.coalesce(operation, F.lit("")).alias("operation")
    )


def meta_context(spark, sf):
    return D.meta_context(rows(spark, sf), CFG).select("correlation_id", "line")


def service_flow(spark, sf):
    return valid(spark, sf).select("correlation_id", X.service_flow(F.col("services")).alias("flow"))


def dedup_messages(spark, sf):
    return D.dedup_messages(rows(spark, sf), CFG).select("correlation_id", "line")


def outcome_line(spark, sf):
    line = X.outcome_line(F.col("outcome"), F.col("request_status_code"), F.col("duration_ms"))
    return valid(spark, sf).select("correlation_id", line.alias("line"))


def semantic_text(spark, sf):
    return D.semantic_text(valid(spark, sf), rows(spark, sf), CFG).select(
        "correlation_id", "semantic_text"
    )


def semantic_text_pieces(spark, sf):
    """Texts as numbered pieces, and whole again where they have up to 400 characters."""
    pieces = staged(D.text_pieces(valid(spark, sf), rows(spark, sf), CFG, 100), "pieces")
    whole = D.whole_texts(pieces, 400).select(
        "correlation_id", F.lit(-1).cast("bigint").alias("piece"), F.col("semantic_text").alias("text"),
        F.length("semantic_text").cast("bigint").alias("chars"),
    )
    return pieces.unionByName(whole)


def semantic_text_budget(spark, sf):
    """With a budget, texts are cut and long lists of meta values left out."""
    cfg = replace(CFG, max_semantic_chars=2000, max_listed_values=5)
    return D.semantic_text(valid(spark, sf), rows(spark, sf), cfg).select(
        "correlation_id", "semantic_text"
    )


def vector_metadata(spark, sf):
    return D.vector_metadata(valid(spark, sf)).select(
        "correlation_id", "project_id", "project_name", text("request_method"),
        text("request_path"), text("request_path_pattern"), number("request_status_code"),
        listed("services", " > "), "max_level", "outcome", number("severity_score"), "fingerprint",
        "has_errors", "has_warnings", "log_count", listed("levels_present"),
        listed("error_types"), F.col("error_types").isNull().alias("no_error_types"),
        listed("suspicious_keywords"), F.col("suspicious_keywords").isNull().alias("no_keywords"),
        "environment", "duration_ms", "timestamp_unix", "last_seen", "occurrence_count",
    )


def trace_documents(spark, sf):
    return whole(spark, sf).new_documents.select("correlation_id", "semantic_text")


# ---- streaming -------------------------------------------------------------


# Log rows that a file of the incoming folder has at least, once there are two of them.
FILE_ROWS = 100_000


def log_files(table: DataFrame, *parts) -> tuple[str, int]:
    """Write the log rows as one folder per part, and the number of files that each one has.

    A step reads one folder more. Files follow the rows, so that many tasks write a large part;
    every part has the same number, by which a micro-batch is admitted.
    """
    base = f"{shared_dir(table.sparkSession)}/incoming/{uuid.uuid4().hex}"
    counts = table.agg(*[F.count_if(condition) for condition in parts]).first()
    files = max(1, min(counts) // FILE_ROWS)
    for position, condition in enumerate(parts):
        rows_ = as_logs(table.where(condition))
        dealt = rows_.coalesce(1) if files == 1 else rows_.repartition(files)
        dealt.write.parquet(f"{base}/part={position}")
    return base, files


def as_logs(table: DataFrame) -> DataFrame:
    return table.select(*[F.col(f.name).cast(f.dataType) for f in S.LOGS])


def new_store(spark: SparkSession) -> TraceStore:
    return TraceStore(spark, f"{shared_dir(spark)}/state/{uuid.uuid4().hex}").create()


def drain(
    spark: SparkSession, sf: str, path: str, store: TraceStore, commits=None, max_files=None, as_of=AS_OF
) -> None:
    """Run the streaming job until the files that are there are used up."""
    stream = L.stream_logs(spark, path, max_files=max_files)
    load = commits or (lambda: fixtures.commits(spark, sf))
    query = run_stream(stream, store, load, STREAM_CFG, as_of=lambda batch_id: as_of)
    query.awaitTermination()


def is_early():
    return F.col("timestamp") <= F.lit(MID_DAY).cast("timestamp_ntz")


def stream_ingest(spark, sf):
    """Three micro-batches cut at midnight, so that no trace is split."""
    (path, _), store = log_files(logs(spark, sf), *thirds()), new_store(spark)
    for part in range(3):
        drain(spark, sf, f"{path}/part=[0-{part}]", store)
    return documents_view(store.documents())


def resume_point(spark, sf):
    """The job is stopped after the first file and picks up at the second."""
    (path, _), store = log_files(logs(spark, sf), is_early(), ~is_early()), new_store(spark)
    drain(spark, sf, f"{path}/part=0", store)
    drain(spark, sf, f"{path}/part=[0-1]", store)
    return store.committed().select("batch_id", "promoted", "dropped", "failed")


def bounded_drain(spark, sf):
    """A drain stops at the input that was there when it started.

    The later half arrives while the first micro-batch runs: when it asks for commits.
    """
    table, arrived = logs(spark, sf), []
    (path, _), store = log_files(table, is_early()), new_store(spark)

    def commits() -> DataFrame:
        if not arrived:
            as_logs(table.where(~is_early())).write.parquet(f"{path}/part=1")
            arrived.append(True)
        return fixtures.commits(spark, sf)

    drain(spark, sf, f"{path}/part=*", store, commits)
    waiting = spark.read.schema(S.LOGS).parquet(f"{path}/part=1").count()
    return renamed(store.counts(), correlation_id="correlationId", n="n").withColumn(
        "waiting", F.lit(waiting).cast("bigint")
    )


def thirds():
    """Three spans of days; no trace lies in two of them."""
    first, second_cut = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-11", "2024-01-21"))
    ts = F.col("timestamp")
    return ts < first, (ts >= first) & (ts < second_cut), ts >= second_cut


def admission_limits(spark, sf):
    """Three parts are waiting; one start takes them as three micro-batches."""
    (path, files), store = log_files(logs(spark, sf), *thirds()), new_store(spark)
    drain(spark, sf, f"{path}/part=*", store, max_files=files)
    taken = store.read("seen").groupBy("batch_id").agg(F.count("*").alias("traces"), F.sum("n").alias("log_rows"))
    return store.committed().select("batch_id", "total").join(taken, "batch_id")


def drained(spark: SparkSession, sf: str, *parts) -> tuple[TraceStore, str, int]:
    """The store after one micro-batch per part, from one start, and the files that were read and how many a part has."""
    (path, files), store = log_files(logs(spark, sf), *parts), new_store(spark)
    drain(spark, sf, f"{path}/part=*", store, max_files=files)
    return store, path, files


def two_batches(spark: SparkSession, sf: str) -> TraceStore:
    return drained(spark, sf, is_early(), ~is_early())[0]


def merge_on_duplicate(spark, sf):
    return documents_view(two_batches(spark, sf).documents())


def late_rows(spark, sf):
    """The older rows arrive after the newer ones."""
    return documents_view(drained(spark, sf, ~is_early(), is_early())[0].documents())


def trace_state(spark, sf):
    """What the keyed state holds of each trace after two micro-batches."""
    state = stored_rows(spark, two_batches(spark, sf).checkpoint)
    return renamed(state, correlation_id="correlationId", n="n")


def idempotent_replay(spark, sf):
    """The job ends before it records its second batch; an hour later that batch runs again.

    It starts from the state of the batch before, and the time of its first run holds.
    """
    store, path, files = drained(spark, sf, is_early(), ~is_early())
    delete_folder(spark, f"{store.checkpoint}/commits/1")
    drain(spark, sf, f"{path}/part=*", store, max_files=files, as_of=AS_OF + 3600)
    return documents_view(store.documents())


def halted_batch(spark, sf):
    """Too many failed traces: the batch stops, and only its failures are on record."""
    store = new_store(spark)
    with suppress(BatchHalted):
        process_batch(store, as_logs(logs(spark, sf)), 0, fixtures.commits(spark, sf), AS_OF, CFG)
    written = store.documents().count() + store.committed().count()
    return store.failures(0).select("correlation_id", "error").withColumn(
        "written", F.lit(written).cast("bigint")
    )


SESSION_GAP, SESSION_DELAY = "2 hours", "12 hours"


def session_windows(spark, sf):
    """Sessions of three micro-batches; some rows of the second come late, some of the third too late."""
    ts, (first, second_cut, _) = F.col("timestamp"), thirds()
    odd = F.col("rowSeq") % 2 == 1
    held = first & (ts >= F.lit("2024-01-10 14:00:00").cast("timestamp_ntz")) & odd
    too_late = (ts < F.lit("2024-01-03").cast("timestamp_ntz")) & odd
    path, files = log_files(
        logs(spark, sf), first & ~held & ~too_late, second_cut | held, ~first & ~second_cut | too_late
    )
    out = f"{shared_dir(spark)}/sessions/{uuid.uuid4().hex}"
    stream = L.stream_logs(spark, f"{path}/part=*", max_files=files)
    run_sessions(stream, out, SESSION_GAP, SESSION_DELAY).awaitTermination()
    return spark.read.parquet(f"{out}/sessions").select(
        F.col("correlationId").alias("correlation_id"), F.unix_micros("start").alias("start_us"),
        F.unix_micros("end").alias("end_us"), "log_count", "errors",
    )


def nested_stream(spark, sf):
    """Nested traces as a stream, with one line cut off: it is recorded and the rest is stored."""
    path = raw_files(spark, sf)
    spark.range(1).select(F.lit('{"correlationId": "cut off').alias("value")).write.mode("append").text(path)
    store = NestedStore(spark, f"{shared_dir(spark)}/nested/{uuid.uuid4().hex}")
    run_nested(stream_raw_traces(spark, path), store, lambda batch_id: AS_OF).awaitTermination()
    kept = store.documents().select("correlation_id", F.lit("").alias("error"), "log_count")
    rejected = store.rejected().where("error = 'invalid_json'").select(
        F.col("record").alias("correlation_id"), "error", F.lit(0).cast("bigint").alias("log_count")
    )
    return kept.unionByName(rejected)


def group_by_project(spark, sf):
    """Three projects use the same IDs, one per day."""
    shared = logs(spark, sf).withColumn("correlationId", F.date_format("timestamp", "yyyy-MM-dd"))
    return O.reassemble_traces(R.flat_rows(L.by_project(shared), AS_OF)).select(
        "correlation_id", "project_id", "log_count", "first_message"
    )


# ---- embeddings ------------------------------------------------------------


def letter_counts():
    """A model for tests that SQL can follow: how often each letter occurs."""

    def encode(texts: list[str]) -> list[np.ndarray]:
        raw = (np.frombuffer(text.lower().encode(), np.uint8) for text in texts)
        return [np.bincount(b, minlength=256)[97:123].astype(np.float32) for b in raw]

    return encode


def model_embeddings(spark, sf):
    """Documents with the vectors of a model that is loaded where they are computed."""
    outcome = run_batch(
        rows(spark, sf), S.empty_table(spark, S.DOCUMENTS), fixtures.commits(spark, sf),
        S.empty_table(spark, S.QUARANTINE), AS_OF, replace(CFG, vector_size=26), letter_counts,
    )
    counts = F.array_join(F.transform("embedding", lambda x: x.cast("bigint")), ",")
    return outcome.new_documents.select("correlation_id", counts.alias("counts"))


def embeddings(spark, sf):
    """Size and content: the term count of each bucket, from the smallest value upwards."""
    vectors = whole(spark, sf).new_documents
    least = F.array_min(F.filter("embedding", lambda x: x > 0))
    # A unit vector holds counts over a common length; one of the terms that occur
    # least often tells the unit, and the texts have words that occur once.
    counts = F.transform("embedding", lambda x: F.round(x / least).cast("bigint"))
    shown = F.filter(
        F.transform(counts, lambda c, i: F.struct(i.alias("bucket"), c.alias("c"))), lambda e: e["c"] > 0
    )
    content = F.array_join(F.transform(shown, lambda e: F.concat_ws(":", e["bucket"], e["c"])), " ")
    return vectors.select(
        "correlation_id", F.size("embedding").cast("bigint").alias("dimensions"), content.alias("content")
    )


REGISTERED: dict[str, Query] = {
    "promotion_rate": promotion_rates,
    "embed_documents": embeddings,
    **{f.__name__: f for f in (
        scan_logs, incremental_filter, batch_slice, trim_split_tail, fetch_cid, latest_commit,
        read_documents, high_water_mark, safe_high_water_mark, process_one_trace,
        upsert_documents, delete_by_cid, increment_occurrence, batch_metrics, quarantine_record,
        quarantine_clear, documents_schema, batch_failure_gate,
        parse_meta, parse_exception, normalize_level, validate_trace, build_request,
        trace_context, log_defaults, resolve_service, normalize_timestamp, request_context,
        flatten_trace, skip_empty_traces, skip_poison, promoted_only, dropped_only,
        detect_partial_traces, refetch_partial_traces, fingerprint_exists, known_fingerprints,
        deploy_window_join, dedup_split,
        reassemble_traces, first_row_context, bulk_count_cids, batch_row_counts,
        chronological_logs, services_in_order, max_level, levels_present, error_flags, log_count,
        error_types, detect_suspicious_keywords, fingerprint_message, occurrence_counts,
        enrich_trace,
        gate_severity, gate_content, gate_cold_start, gate_deploy_window, gate_new_fingerprint,
        gate_default, gatekeeper, gatekeeper_with_store, verdict,
        normalize_message, extract_error_type, has_suspicious_keywords, classify_outcome,
        trace_severity, normalize_request_path, trace_fingerprint, normalize_for_dedup,
        http_operation, meta_context, service_flow, dedup_messages, outcome_line, semantic_text,
        semantic_text_budget, vector_metadata, trace_documents,
        stream_ingest, resume_point, bounded_drain, merge_on_duplicate, late_rows,
        fingerprint_buckets, session_windows, nested_stream, group_by_project, model_embeddings, deploy_as_of_trace, semantic_text_pieces,
        idempotent_replay, halted_batch, admission_limits, trace_state, tied_positions, validate_gaps, refetch_without_order, gatekeeper_without_store,
    )},
}


def registered() -> dict[str, Query]:
    def ready(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(apply_settings(spark), sf_dir)

        return run

    return {name: ready(query) for name, query in REGISTERED.items()}
