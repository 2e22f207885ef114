"""Trace features.

``trace_features`` works in two levels. Each row names its *facets*: its logger,
its error type and its keywords. Rows are first folded by (correlation ID, facet)
with map-side combine, so a correlation ID that holds a large part of all rows is
spread over its facets and shrinks before it is shuffled. The second level folds
facets into traces: its lists hold the distinct loggers, types and keywords of a
trace, which are part of the result, and no combination of them.

Traces that come packed, all rows of one in a list, are folded where they are, without
a shuffle or a sort. Very long ones are unpacked and go the way of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.config import EngineConfig
from tracemill.functions import messages as M
from tracemill.functions import traces as T
from tracemill.operators.ranges import Stage, running
from tracemill.operators.rows import (
    CONTEXT, NO_ERROR, PACKED, ROW_ERRORS, error_text, is_packed, log_bits, log_context, unpacked,
)
from tracemill.session import staged

ORDER = ("ls_ts", "row_seq")
FIRST_ERROR, FIRST_SUSPICIOUS, LAST = 0, 1, 2
# The error of a trace that was not looked at because it failed too often before.
SKIPPED = "skipped"


def order_key() -> Column:
    return F.struct(*ORDER)


def _any(condition: Column) -> Column:
    return F.bool_or(F.coalesce(condition, F.lit(False)))


# ---- single features -------------------------------------------------------


def first_row_context(rows: DataFrame) -> DataFrame:
    """Trace fields, taken from the first row of each trace."""
    first = F.min(F.struct(*ORDER, *CONTEXT)).alias("first")
    return rows.groupBy("correlation_id").agg(first).select(
        "correlation_id", *[F.col(f"first.{c}").alias(c) for c in CONTEXT]
    )


def reassemble_traces(rows: DataFrame) -> DataFrame:
    """One row per trace: context, log count, time span, first and last message."""
    context = F.min(F.struct(*ORDER, *CONTEXT, "message")).alias("first")
    last = F.max(F.struct(*ORDER, "message")).alias("last")
    return (
        rows.groupBy("correlation_id")
        .agg(F.count("*").alias("log_count"), context, last)
        .select(
            "correlation_id",
            *[F.col(f"first.{c}").alias(c) for c in CONTEXT],
            "log_count",
            F.col("first.ls_ts").alias("first_ts"),
            F.col("last.ls_ts").alias("last_ts"),
            F.col("first.message").alias("first_message"),
            F.col("last.message").alias("last_message"),
        )
    )


def chronological_logs(rows: DataFrame, stage: Stage = staged) -> DataFrame:
    """Rows with their 1-based position in the trace.

    A very long trace is ranked by many tasks instead of one, also where its rows share
    one instant (see ``ranges``). ``stage`` writes the rows once.
    """
    return running(rows, ["correlation_id"], ORDER, stage, {"position": F.lit(1)})


def first_seen(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Distinct non-empty values per trace, in order of first appearance."""
    seen = (
        rows.select("correlation_id", *ORDER, value.alias("value"))
        .where(F.col("value") != "")
        .groupBy("correlation_id", "value")
        .agg(F.min(order_key()).alias("ord"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("ord", "value")))
    return seen.groupBy("correlation_id").agg(ordered["value"].alias(name))


def services_in_order(rows: DataFrame) -> DataFrame:
    loggers = (
        rows.groupBy("correlation_id", "logger_name")
        .agg(F.min(F.struct(*ORDER, "component", "project_name")).alias("first"))
        .groupBy("correlation_id")
        .agg(
            F.min("first").alias("first"),
            F.sort_array(F.collect_list(F.struct(F.col("first").alias("ord"), "logger_name")))
            .alias("seen"),
        )
    )
    names = F.col("seen.logger_name")
    return loggers.select("correlation_id", _services(names, "first").alias("services"))


def _services(loggers: Column, first: str) -> Column:
    return F.array_distinct(
        F.transform(
            loggers,
            lambda name: M.resolve_service(
                name, F.col(f"{first}.component"), F.col(f"{first}.project_name")
            ),
        )
    )


def with_service(rows: DataFrame) -> DataFrame:
    """Rows with their service; an empty logger falls back to the trace's fields."""
    context = first_row_context(rows).select(
        "correlation_id", F.col("component").alias("c"), F.col("project_name").alias("p")
    )
    service = M.resolve_service(F.col("logger_name"), F.col("c"), F.col("p"))
    return rows.join(context, "correlation_id").withColumn("service", service).drop("c", "p")


def error_types(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    found = M.extract_error_type(F.col("message"), F.col("meta"), cfg.error_prefix_chars)
    return first_seen(rows, found, "error_types")


def suspicious_keywords(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Distinct keywords per trace: by log, then by their place in the list."""
    joined = M.matched_keywords("lowered", cfg.suspicious_keywords)
    hits = rows.select("correlation_id", *ORDER, joined.alias("joined")).where("joined != ''").select(
        "correlation_id", *ORDER, F.posexplode(M.split_keywords(F.col("joined"))).alias("i", "keyword")
    )
    seen = hits.groupBy("correlation_id", "keyword").agg(F.min(F.struct(*ORDER, "i")).alias("ord"))
    ordered = F.sort_array(F.collect_list(F.struct("ord", "keyword")))
    return seen.groupBy("correlation_id").agg(ordered["keyword"].alias("suspicious_keywords"))


def level_features(rows: DataFrame) -> DataFrame:
    rank = F.max("level_rank")
    return rows.groupBy("correlation_id").agg(
        M.level_name(F.coalesce(rank, F.lit(0))).alias("max_level"),
        levels_present(F.bit_or(level_bit())).alias("levels_present"),
        _any(F.col("level_rank") >= M.ERROR_RANK).alias("has_errors"),
        _any(F.col("level_rank") == M.WARN_RANK).alias("has_warnings"),
        F.count("*").alias("log_count"),
    )


def level_bit() -> Column:
    bit = F.lit(0)
    for position, level in enumerate(M.LEVELS):
        bit = F.when(F.col("level") == level, 1 << position).otherwise(bit)
    return bit


def levels_present(bits: Column) -> Column:
    """Distinct levels, sorted by name."""
    present = {
        level: F.when(bits.bitwiseAND(1 << position) != 0, level)
        for position, level in enumerate(M.LEVELS)
    }
    return F.array_compact(F.array(*[present[level] for level in sorted(present)]))


def fingerprint_kind(rank: Column, suspicious: Column) -> Column:
    return (
        F.when(rank >= M.ERROR_RANK, FIRST_ERROR)
        .when(suspicious, FIRST_SUSPICIOUS)
        .otherwise(LAST)
    )


def fingerprint_candidate(kind: Column, at: Column, row_seq: Column, message: Column) -> Column:
    """Ordering key plus message; the smallest one represents the trace.

    First error, else first message with a keyword, else the last message. For
    the last kind the order runs backwards.
    """
    direction = F.when(kind == LAST, -1).otherwise(1)
    return F.struct(
        kind.alias("kind"),
        (direction * F.unix_micros(at)).alias("at"),
        (direction * row_seq).alias("seq"),
        message.alias("message"),
    )


def row_candidate(suspicious: Column) -> Column:
    kind = fingerprint_kind(F.col("level_rank"), suspicious)
    return fingerprint_candidate(kind, F.col("ls_ts"), F.col("row_seq"), F.col("message"))


def fingerprint_message(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    suspicious = M.contains_any("lowered", cfg.suspicious_keywords)
    pick = F.min(row_candidate(suspicious))
    return rows.groupBy("correlation_id").agg(pick["message"].alias("message"))


def validate_traces(rows: DataFrame) -> DataFrame:
    """Error text per trace, NULL when the trace is valid."""
    no_project = F.min(F.struct(*ORDER, "project_id"))["project_id"].isNull()
    bits = F.bit_or("error_bits").bitwiseOR(
        F.when(no_project, ROW_ERRORS["missing_project"]).otherwise(NO_ERROR)
    )
    return rows.groupBy("correlation_id").agg(error_text(bits).alias("error"))


# ---- all features at once --------------------------------------------------

# The part of the context that documents need; the rest stays out of the shuffle.
CARRIED = tuple(c for c in CONTEXT if c not in ("started_at", "ended_at"))


LOGGER, TYPE, KEYWORD = "logger", "type", "keyword"


def facets(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Rows folded by (trace, facet kind, facet value).

    Every row has exactly one logger facet, which carries what is counted or
    picked per trace. Facets of an invalid row are blanked: its trace fails as a
    whole, so they are never read, and a flood of bad rows collapses into one.
    """
    message = F.col("message")
    usable = F.col("error_bits") == NO_ERROR
    found = M.extract_error_type(message, F.col("meta"), cfg.error_prefix_chars)
    scanned = rows.withColumns({
        "error_type": F.when(usable, F.nullif(found, F.lit(""))),
        "keywords": F.when(usable, M.matched_keywords("lowered", cfg.suspicious_keywords)),
        "critical": M.contains_any("lowered", cfg.critical_keywords),
    })
    whole = F.struct(
        F.struct(*ORDER, *CARRIED).alias("first"),
        row_candidate(F.col("keywords").isNotNull()).alias("pick"),
        F.when(F.col("in_batch"), F.col("ls_ts")).alias("entered_at"),
        F.col("in_batch"), F.col("error_bits"), F.col("level_rank"), F.col("critical"),
        level_bit().alias("level_bits"),
    )

    def facet(kind: str, value: Column, at: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"), at.cast("int").alias("at"))

    named = F.transform(M.split_keywords(F.col("keywords")), lambda k, i: facet(KEYWORD, k, i))
    none = F.array().cast("array<struct<kind:string,value:string,at:int>>")
    listed = F.concat(
        F.array(facet(LOGGER, F.when(usable, F.col("logger_name")), F.lit(0))),
        F.when(F.col("error_type").isNotNull(), F.array(facet(TYPE, F.col("error_type"), F.lit(0)))).otherwise(none),
        F.when(F.col("keywords").isNotNull(), named).otherwise(none),
    )
    rows_by_facet = scanned.select("correlation_id", *ORDER, whole.alias("whole"), F.explode(listed).alias("facet")).select(
        "correlation_id", F.col("facet.kind").alias("kind"), F.col("facet.value").alias("value"),
        F.struct(*ORDER, "facet.at").alias("ord"),
        F.when(F.col("facet.kind") == LOGGER, F.col("whole")).alias("whole"),
    )
    return rows_by_facet.groupBy("correlation_id", "kind", "value").agg(
        F.min("ord").alias("ord"),
        F.count("whole").alias("log_count"),
        F.min("whole.first").alias("first"),
        F.min("whole.pick").alias("pick"),
        F.min("whole.entered_at").alias("entered_at"),
        F.bool_and("whole.in_batch").alias("in_batch"),
        F.bit_or("whole.error_bits").alias("error_bits"),
        F.max("whole.level_rank").alias("level_rank"),
        F.bit_or("whole.level_bits").alias("level_bits"),
        F.bool_or("whole.critical").alias("critical"),
    )


def trace_features(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per trace, valid or not; ``error`` tells which. ``rows`` may be packed."""
    if is_packed(rows):
        long = unpacked(rows.where(F.col("n") > LONG_TRACE))
        folded = folded_lists(rows.where(F.col("n") <= LONG_TRACE), cfg).unionByName(folded_rows(long, cfg))
    else:
        folded = folded_rows(rows, cfg)
    no_project = F.col("first.project_id").isNull()
    bits = F.col("error_bits").bitwiseOR(
        F.when(no_project, ROW_ERRORS["missing_project"]).otherwise(NO_ERROR)
    )
    base = folded.select(
        "correlation_id",
        *[F.col(f"first.{c}").alias(c) for c in CARRIED],
        "log_count",
        F.col("first.ls_ts").alias("first_ts"),
        F.unix_seconds("first.ls_ts").alias("timestamp_unix"),
        "entered_at",
        (~F.col("in_batch")).alias("is_merge"),
        error_text(bits).alias("error"),
        "level_rank",
        M.level_name(F.col("level_rank")).alias("max_level"),
        levels_present(F.col("level_bits")).alias("levels_present"),
        (F.col("level_rank") >= M.ERROR_RANK).alias("has_errors"),
        (F.col("level_bits").bitwiseAND(1 << M.WARN_RANK) != 0).alias("has_warnings"),
        _services(F.col("loggers"), "first").alias("services"),
        "error_types",
        "suspicious_keywords",
        "critical",
        F.col("pick.message").alias("fingerprint_message"),
    )
    return _derived(base).drop("level_rank", "critical")


def folded_rows(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    folded = (
        facets(rows, cfg)
        .groupBy("correlation_id")
        .agg(
            F.sum("log_count").alias("log_count"),
            F.min("first").alias("first"),
            F.min("pick").alias("pick"),
            F.min("entered_at").alias("entered_at"),
            F.bool_and("in_batch").alias("in_batch"),
            F.bit_or("error_bits").alias("error_bits"),
            F.coalesce(F.max("level_rank"), F.lit(0)).alias("level_rank"),
            F.bit_or("level_bits").alias("level_bits"),
            _any(F.col("critical")).alias("critical"),
            F.sort_array(F.collect_list(F.struct("ord", "kind", "value"))).alias("seen"),
        )
    )

    def seen(kind: str) -> Column:
        return F.filter("seen", lambda s: s["kind"] == kind)["value"]

    return folded.select(
        *FOLDED, seen(LOGGER).alias("loggers"), seen(TYPE).alias("error_types"),
        seen(KEYWORD).alias("suspicious_keywords"),
    )


FOLDED = (
    "correlation_id", "log_count", "first", "pick", "entered_at", "in_batch", "error_bits", "level_rank",
    "level_bits", "critical",
)
#: Packed traces of more rows are unpacked, so that no expression holds all rows of a very long one.
LONG_TRACE = 10_000


def folded_lists(traces: DataFrame, cfg: EngineConfig) -> DataFrame:
    """As ``folded_rows``, of packed traces: what aggregates do there, functions of lists do here."""

    words = dict.fromkeys((*cfg.suspicious_keywords, *cfg.critical_keywords))
    message, meta = F.col(f"{PACKED}.row.message"), F.col(f"{PACKED}.row.meta")

    def joined(values: Column) -> Column:
        return F.array_join(values, M.KEYWORD_SEPARATOR)

    def canonical(item: Column, i: Column) -> Column:
        row = item["row"]
        at = F.coalesce(row["timestamp"], F.timestamp_seconds(F.col("as_of")))
        return F.struct(
            at.alias("ls_ts"), row["rowSeq"].alias("row_seq"),
            log_bits(row.getField, F.get("levels", i)).alias("error_bits"),
            (item["at"] == F.col("batch_at")).alias("in_batch"), row.alias("row"),
        )

    # Tests of a whole trace's text come first: most traces need no look at each row.
    tested = traces.withColumn(
        "levels", F.transform(F.col(f"{PACKED}.row.level"), M.normalize_level)
    ).withColumns({
        "rows": F.transform(PACKED, canonical), "ranks": F.transform("levels", M.level_rank), "texts": message,
        "lowered": F.lower(joined(message)), "named": joined(message), "metas": joined(meta),
    }).drop(PACKED).withColumns({
        "has_words": M.contains_any("lowered", words),
        "has_types": M.contains_any("named", M.TYPE_MARKS) | F.coalesce(F.contains("metas", F.lit(M.TYPE_KEY)), F.lit(False)),
        "bits": F.col("rows.error_bits"),
    })
    found = F.expr(f"""CASE WHEN has_words THEN transform(transform(texts, t -> lower(t)), (t, i) -> struct(
        CASE WHEN bits[i] = {NO_ERROR} THEN {M.matched_keywords_sql("t", cfg.suspicious_keywords)} END AS keywords,
        {M.contains_any_sql("t", cfg.critical_keywords)} AS critical)) END""")
    scanned = tested.withColumn("found", found).withColumn(
        "kinds", F.transform("ranks", lambda rank, i: fingerprint_kind(rank, F.get("found", i)["keywords"].isNotNull()))
    )

    def usable(r: Column, value: Column) -> Column:
        return F.when(r["error_bits"] == NO_ERROR, value)

    def order(r: Column) -> list[Column]:
        return [r[name].alias(name) for name in ORDER]

    def first(r: Column) -> Column:
        context = log_context(r["row"].getField)
        return F.struct(*order(r), *[context[name].alias(name) for name in CARRIED])

    def error_type(r: Column) -> Column:
        named = M.extract_error_type(r["row"]["message"], r["row"]["meta"], cfg.error_prefix_chars)
        return F.struct(*order(r), usable(r, F.nullif(named, F.lit(""))).alias("value"))

    def keywords(r: Column, i: Column) -> Column:
        hits = M.split_keywords(F.get("found", i)["keywords"])
        return F.transform(hits, lambda k, at: F.struct(*order(r), at.alias("at"), k.alias("value")))

    def in_order(values: Column) -> Column:
        """Distinct values by their first place."""
        return F.array_distinct(F.sort_array(values)["value"])

    def either(values: str, bits: Callable[[Column], Column]) -> Column:
        return F.aggregate(values, F.lit(0), lambda all_, value: all_.bitwiseOR(bits(value)))

    types = F.filter(F.transform("rows", error_type), lambda t: t["value"].isNotNull())
    none = F.array().cast("array<string>")
    powers = F.array(*[F.lit(1 << position) for position in range(len(M.LEVELS))])
    return scanned.select(
        "correlation_id",
        F.size("rows").cast("bigint").alias("log_count"),
        F.array_min(F.transform("rows", first)).alias("first"),
        F.array_min(F.transform("rows", lambda r, i: fingerprint_candidate(
            F.get("kinds", i), r["ls_ts"], r["row_seq"], r["row"]["message"]))).alias("pick"),
        F.array_min(F.transform("rows", lambda r: F.when(r["in_batch"], r["ls_ts"]))).alias("entered_at"),
        F.forall("rows", lambda r: r["in_batch"]).alias("in_batch"),
        either("bits", lambda bits: bits).alias("error_bits"),
        F.coalesce(F.array_max("ranks"), F.lit(0)).alias("level_rank"),
        either("ranks", lambda rank: F.coalesce(F.get(powers, rank), F.lit(0))).alias("level_bits"),
        F.coalesce(F.exists("found", lambda f: f["critical"]), F.lit(False)).alias("critical"),
        in_order(F.transform("rows", lambda r: F.struct(
            *order(r), usable(r, r["row"]["loggerName"]).alias("value")))).alias("loggers"),
        F.when(F.col("has_types"), in_order(types)).otherwise(none).alias("error_types"),
        F.when(F.col("has_words"), in_order(F.flatten(F.transform("rows", keywords)))).otherwise(none).alias("suspicious_keywords"),
    )


def _derived(base: DataFrame) -> DataFrame:
    outcome = T.classify_outcome(F.col("request_status_code"), F.col("level_rank"))
    return (
        base.withColumn("outcome", outcome)
        .withColumn(
            "severity_score",
            T.trace_severity(F.col("max_level"), F.col("outcome"), F.col("critical")),
        )
        .withColumn("request_path_pattern", T.normalize_request_path(F.col("request_path")))
        .withColumn(
            "fingerprint",
            T.trace_fingerprint(
                F.col("services"), F.col("max_level"), F.col("fingerprint_message")
            ),
        )
    )


def valid_traces(features: DataFrame) -> DataFrame:
    return features.where(F.col("error").isNull()).drop("error")


def failed_traces(features: DataFrame) -> DataFrame:
    return features.where(F.col("error") != SKIPPED).select("correlation_id", "error")
