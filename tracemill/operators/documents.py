"""Trace documents: text, metadata and their place in the stored state."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tracemill.config import EngineConfig
from tracemill.functions import messages as M
from tracemill.functions import text as X
from tracemill.operators.gate import INSERT, REPEAT
from tracemill.operators.rows import parse_json_column
from tracemill.operators.ranges import Stage, running
from tracemill.operators.traces import ORDER
from tracemill.schemas import DOCUMENTS, empty_table
from tracemill.session import path_exists, staged

# Meta keys that never enter the text. Keys are compared in lower
# case, so the camel-case entry has no effect.
SKIPPED_META_KEYS = (
    "logger", "loggername", "correlationId", "correlation_id", "level", "timestamp",
)
# Levels whose lines carry a tag when ``tag_levels`` is on.
TAGGED_LEVELS = ("warn", "error", "fatal")

DOCUMENT_KEY = ["project_id", "correlation_id"]


def rows_of(rows: DataFrame, traces: DataFrame) -> DataFrame:
    """Rows of the given traces."""
    return rows.join(traces.select("correlation_id"), "correlation_id", "left_semi")


# ---- text lines ------------------------------------------------------------
#
# Messages and meta entries become items of one shape, so that one pass over the
# rows and one shuffle serve both.

ENTRY, LINE = "entry", "line"


def message_items(cfg: EngineConfig) -> Column:
    """The message of a row as a text line, keyed by its normalized form."""
    line = M.strip(F.col("message"))
    text = line
    if cfg.tag_levels:
        tag = F.concat(F.lit("["), F.upper("level"), F.lit("] "))
        text = F.concat(F.when(F.col("level").isin(*TAGGED_LEVELS), tag).otherwise(""), line)
    item = F.struct(
        F.lit(LINE).alias("layer"), M.normalize_for_dedup(F.col("message")).alias("key"),
        F.lit(0).alias("pos"), text.alias("text"),
    )
    return F.when(line != "", F.array(item))


def _showable(key: Column, value: Column, cfg: EngineConfig) -> Column:
    kind = F.schema_of_variant(value)
    usable = (
        ~F.lower(key).isin(*SKIPPED_META_KEYS)
        & ~F.is_variant_null(value)
        & ~kind.startswith("OBJECT")
    )
    if cfg.max_listed_values is None:
        return usable
    short = F.size(F.try_variant_get(value, "$", "array<variant>")) <= cfg.max_listed_values
    return usable & (~kind.startswith("ARRAY") | short)


def meta_items(cfg: EngineConfig) -> Column:
    """The usable meta entries of a row as ``key=value``, in document order.

    Values that cannot be shown are left out here, so they do not claim their key.
    """
    entries = F.map_entries(parse_json_column(F.col("meta")))
    usable = F.filter(entries, lambda e: _showable(e["key"], e["value"], cfg))
    return F.transform(usable, lambda e, i: F.struct(
        F.lit(ENTRY).alias("layer"), e["key"].alias("key"), i.alias("pos"),
        F.concat(e["key"], F.lit("="), M.python_text(e["value"])).alias("text"),
    ))


def first_items(rows: DataFrame, items: Column) -> DataFrame:
    """The first item per (trace, layer, key), with the place where it occurs."""
    return (
        rows.select("correlation_id", *ORDER, F.explode(items).alias("item"))
        .select("correlation_id", "item.layer", "item.key",
                F.struct(*ORDER, "item.pos", "item.text").alias("at"))
        .groupBy("correlation_id", "layer", "key")
        .agg(F.min("at").alias("at"))
    )


def dedup_messages(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per distinct line of a trace."""
    return first_items(rows, message_items(cfg)).select(
        "correlation_id", F.col("at.text").alias("line")
    )


def meta_context(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One ``key=value`` row per distinct usable meta key of a trace."""
    return first_items(rows, meta_items(cfg)).select(
        "correlation_id", F.col("at.text").alias("line")
    )


def text_items(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Every distinct entry and line of the traces, with the place of its first occurrence."""
    none = F.array().cast("array<struct<layer:string,key:string,pos:int,text:string>>")
    items = F.concat(F.coalesce(message_items(cfg), none), F.coalesce(meta_items(cfg), none))
    return first_items(rows, items)


def text_lines(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """``entries`` and ``lines`` per trace: every distinct one, in order.

    With a text budget, lines that start beyond it are left out before they are
    collected; what is kept still overruns the budget, so the cut is the same. Without
    one, every trace has all its lines, unless ``whole_text_chars`` is set: a trace whose
    lines are longer has none here, for callers that take them from ``text_pieces``.
    """
    needed = text_items(rows, cfg)
    if cfg.max_semantic_chars is not None:
        before = Window.partitionBy("correlation_id", "layer").orderBy("at").rowsBetween(
            Window.unboundedPreceding, -1
        )
        start = F.coalesce(F.sum(F.length("at.text") + 2).over(before), F.lit(0))
        needed = needed.withColumn("start", start).where(F.col("start") <= cfg.max_semantic_chars)
    elif cfg.whole_text_chars is not None:
        # Nearly always empty, which adaptive execution sees before it joins.
        long = needed.groupBy("correlation_id").agg(F.sum(F.length("at.text")).alias("chars")).where(
            F.col("chars") > cfg.whole_text_chars
        )
        needed = needed.join(long.select("correlation_id"), "correlation_id", "left_anti")

    def ordered(layer: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("layer") == layer, F.col("at"))))["text"]

    return needed.groupBy("correlation_id").agg(
        ordered(ENTRY).alias("entries"), ordered(LINE).alias("lines")
    )


OPERATION, CONTEXT, FLOW, MESSAGES, OUTCOME = range(5)
# What the lines of a trace itself are made of.
TEXT_FIELDS = ("request_method", "request_path_pattern", "request_path", "duration_ms", "services", "outcome", "request_status_code")


def text_pieces(
    traces: DataFrame, rows: DataFrame, cfg: EngineConfig, piece_chars: int, stage: Stage = staged
) -> DataFrame:
    """(correlation_id, piece, text, chars): the whole text of each trace in numbered pieces.

    Every piece but the last has ``piece_chars`` characters; ``chars`` are those of the text
    up to the piece's end. Lines are ranked over ranges and cut where they cross a
    boundary, so that no row and no task holds more of a text than a piece, however long the
    trace.
    """
    # Read twice: for the lines of its own and for the choice of rows.
    traces = stage(traces.select("correlation_id", *TEXT_FIELDS), "traces")
    place = F.struct(*ORDER, F.lit(0).alias("pos"), F.col("text"))
    named = [
        (OPERATION, X.http_operation(F.col("request_method"), F.col("request_path_pattern"),
                                     F.col("request_path"), F.col("duration_ms"))),
        (FLOW, X.service_flow(F.col("services"))),
        (OUTCOME, X.outcome_line(F.col("outcome"), F.col("request_status_code"), F.col("duration_ms"))),
    ]
    single = traces.select(
        "correlation_id", F.lit(None).cast("timestamp").alias(ORDER[0]), F.lit(None).cast("bigint").alias(ORDER[1]),
        F.explode(F.array(*[F.struct(F.lit(n).alias("layer"), text.alias("text")) for n, text in named])).alias("one"),
    ).select("correlation_id", *ORDER, "one.*").where("text is not null").select("correlation_id", "layer", place.alias("at"))
    found = text_items(rows_of(rows, traces), cfg).select(
        "correlation_id", F.when(F.col("layer") == ENTRY, CONTEXT).otherwise(MESSAGES).alias("layer"), "at"
    )
    entry = (F.col("layer") == CONTEXT).cast("int")
    placed = running(
        single.unionByName(found), ["correlation_id"], ["layer", "at"], stage,
        {"position": F.lit(1), "entries": entry, "sizes": F.length("at.text") + len(X.LAYER_SEPARATOR)},
    )
    first_entry = (F.col("layer") == CONTEXT) & (F.col("entries") == 1)
    between = F.when((F.col("layer") == CONTEXT) & ~first_entry, X.ENTRY_SEPARATOR).otherwise(X.LAYER_SEPARATOR)
    text = F.concat(
        F.when(F.col("position") == 1, "").otherwise(between),
        F.when(first_entry, X.CONTEXT_LABEL).otherwise(""), F.col("at.text"),
    )
    label = F.when(F.col("entries") > 0, len(X.CONTEXT_LABEL)).otherwise(0)
    end = F.col("sizes") - len(X.LAYER_SEPARATOR) + label
    cut = (
        placed.select("correlation_id", text.alias("text"), end.alias("end"))
        .withColumn("start", F.col("end") - F.length("text"))
        .where("start < end")
        .withColumn("piece", F.explode(F.sequence(
            F.floor(F.col("start") / piece_chars), F.floor((F.col("end") - 1) / piece_chars))))
    )
    begins = F.greatest(F.col("start"), F.col("piece") * piece_chars)
    stops = F.least(F.col("end"), (F.col("piece") + 1) * piece_chars)
    part = F.substring("text", (begins - F.col("start") + 1).cast("int"), (stops - begins).cast("int"))
    return (
        cut.select("correlation_id", "piece", F.struct(begins.alias("at"), part.alias("text")).alias("part"), stops.alias("chars"))
        .groupBy("correlation_id", "piece")
        .agg(F.array_join(F.sort_array(F.collect_list("part"))["text"], "").alias("text"), F.max("chars").alias("chars"))
    )


def whole_texts(pieces: DataFrame, max_chars: int) -> DataFrame:
    """(correlation_id, semantic_text) of the texts of up to ``max_chars`` characters, put together again."""
    short = pieces.groupBy("correlation_id").agg(F.max("chars").alias("chars")).where(F.col("chars") <= max_chars)
    held = pieces.join(short.select("correlation_id"), "correlation_id", "left_semi")
    ordered = F.sort_array(F.collect_list(F.struct("piece", "text")))["text"]
    return held.groupBy("correlation_id").agg(F.array_join(ordered, "").alias("semantic_text"))


def semantic_text(traces: DataFrame, rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """``traces`` with their ``semantic_text``; ``rows`` are the rows of these traces."""
    none = F.array().cast("array<string>")
    lines = text_lines(rows, cfg)
    layers = [
        X.http_operation(F.col("request_method"), F.col("request_path_pattern"),
                         F.col("request_path"), F.col("duration_ms")),
        X.context_line(F.coalesce("entries", none)),
        X.service_flow(F.col("services")),
        F.coalesce("lines", none),
        X.outcome_line(F.col("outcome"), F.col("request_status_code"), F.col("duration_ms")),
    ]
    return (
        traces.join(lines, "correlation_id", "left")
        .withColumn("semantic_text", X.assemble(layers, cfg.max_semantic_chars))
        .drop("entries", "lines")
    )


# ---- documents -------------------------------------------------------------


def vector_metadata(traces: DataFrame) -> DataFrame:
    """The flat metadata of each trace; an absent optional key is NULL."""

    def if_any(name: str) -> Column:
        return F.when(F.size(name) > 0, F.col(name)).alias(name)

    return traces.select(
        "correlation_id", "project_name", "project_id", "request_method", "request_path",
        "request_path_pattern", "request_status_code", "services", "max_level", "outcome",
        "severity_score", "fingerprint", "has_errors", "has_warnings", "log_count",
        "levels_present", "environment", "duration_ms", "timestamp_unix",
        if_any("error_types"), if_any("suspicious_keywords"),
        F.lit(1).cast("bigint").alias("occurrence_count"),
        F.col("timestamp_unix").alias("last_seen"),
        *[c for c in ("semantic_text", "entered_at") if c in traces.columns],
    )


def trace_documents(traces: DataFrame, rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """A document per trace. No pieces are stored beside it, so ``whole_text_chars`` does not hold here."""
    return vector_metadata(semantic_text(traces, rows, replace(cfg, whole_text_chars=None)))


def inserted_only(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(F.col("operation") == INSERT)


def repeats(verdicts: DataFrame, as_of: int) -> DataFrame:
    """How often each kept document was seen again."""
    return (
        verdicts.where(F.col("operation") == REPEAT)
        .groupBy("project_id", F.col("keeper").alias("correlation_id"))
        .agg(F.count("*").alias("n"))
        .withColumn("seen", F.lit(as_of).cast("bigint"))
    )


def increment_occurrence(documents: DataFrame, repeated: DataFrame) -> DataFrame:
    """Add repeats to the counts; ``last_seen`` moves only for repeated documents."""
    return documents.join(repeated, DOCUMENT_KEY, "left").withColumns({
        "occurrence_count": F.col("occurrence_count") + F.coalesce("n", F.lit(0)),
        "last_seen": F.coalesce("seen", "last_seen"),
    }).select(*documents.columns)


def delete_by_cid(documents: DataFrame, touched: DataFrame) -> DataFrame:
    """Documents without those of the touched traces."""
    return documents.join(touched.select(*DOCUMENT_KEY), DOCUMENT_KEY, "left_anti")


def upsert(documents: DataFrame, new: DataFrame) -> DataFrame:
    return documents.unionByName(new, allowMissingColumns=True)


def write_documents(documents: DataFrame, path: str) -> str:
    """Write a document table partitioned by project; a hot project is split over tasks."""
    typed = documents.select(*[F.col(f.name).cast(f.dataType) for f in DOCUMENTS])
    typed.hint("rebalance", "project_id").write.partitionBy("project_id").parquet(path)
    return path


def read_documents(spark: SparkSession, path: str, project: str | None = None) -> DataFrame:
    """Stored documents, of one project if named; a store that was never written is empty."""
    if not path_exists(spark, path):
        return empty_table(spark, DOCUMENTS)
    found = spark.read.schema(DOCUMENTS).parquet(path)
    found = found if project is None else found.where(F.col("project_id") == project)
    return found.select(*DOCUMENTS.names)


def checked_documents(documents: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The documents schema; a vector of the wrong size fails the job."""
    size = F.size("embedding")
    wrong = F.raise_error(F.format_string(f"vector of %d values, not {cfg.vector_size}", size))
    checked = F.when(size == cfg.vector_size, F.col("embedding")).otherwise(wrong)
    return documents.withColumn("embedding", checked.cast("array<float>")).select(
        *[F.col(field.name).cast(field.dataType) for field in DOCUMENTS]
    )


def occurrence_counts(verdicts: DataFrame) -> DataFrame:
    """Promoted traces per fingerprint over a whole run from an empty store."""
    return (
        verdicts.where(F.col("action") == "PROMOTE")
        .groupBy("project_id", "fingerprint")
        .agg(F.count("*").alias("occurrence_count"))
    )
