"""From source rows to canonical rows.

Canonical rows carry everything later steps need, computed before any shuffle:
order, level, validity bits and the trace context as this row would supply it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions import messages as M

# Validity bits. One bad row fails its whole trace, so bits are OR-ed per trace.
ROW_ERRORS = {
    "missing_correlation_id": 1,
    "missing_project": 2,
    "invalid_level": 4,
    "missing_message": 8,
    "missing_logger": 16,
    "invalid_meta": 32,
    "invalid_exception": 64,
    "invalid_integer": 128,
    "missing_started_at": 256,
    "missing_timestamp": 512,
    "missing_environment": 1024,
}
NO_ERROR = 0

CONTEXT = (
    "project_id", "project_name", "environment", "component", "started_at", "ended_at",
    "duration_ms", "request_method", "request_path", "request_status_code",
)
# Defaults that apply when the source lacks the column altogether.
COLUMN_DEFAULTS = {
    "correlationId": ("unknown", "string"),
    "projectId": ("", "string"),
    "timestamp": (None, "timestamp"),
    "level": ("INFO", "string"),
    "loggerName": (None, "string"),
    "message": ("", "string"),
    "meta": (None, "string"),
    "exception": (None, "string"),
    "sessionStartedAt": (None, "timestamp"),
    "sessionEndedAt": (None, "timestamp"),
    "durationMs": (None, "bigint"),
    "requestMethod": (None, "string"),
    "requestPath": (None, "string"),
    "statusCode": (None, "int"),
}


def error_bit(name: str, failed: Column) -> Column:
    return F.when(failed, ROW_ERRORS[name]).otherwise(NO_ERROR)


def error_text(bits: Column) -> Column:
    """Comma-separated error names, or NULL when the row or trace is valid."""
    names = [F.when(bits.bitwiseAND(bit) != 0, name) for name, bit in ROW_ERRORS.items()]
    return F.when(bits != NO_ERROR, F.concat_ws(", ", *names))


# How a JSON value other than an object or null can start, and the
# number words that lenient readers accept.
NON_OBJECT_START = r'^[ \t\r\n]*["\[0-9tf-]'
NUMBER_WORDS = ("NaN", "Infinity", "-Infinity")


def _first_char(text: Column) -> Column:
    return F.substring(F.ltrim(text, F.lit(" \t\r\n")), 1, 1)


def is_json_object(text: Column) -> Column:
    return F.coalesce(
        (_first_char(text) == "{") & F.try_parse_json(text).isNotNull(), F.lit(False)
    )


def is_json_non_object(text: Column) -> Column:
    """Valid JSON that is neither an object nor null.

    The first character rules out nearly every row before the parser runs.
    """
    first = _first_char(text)
    possible = (first != "{") & (first != "") & text.rlike(NON_OBJECT_START)
    other = F.when(possible, F.try_parse_json(text).isNotNull()).otherwise(False)
    return other | F.coalesce(F.trim(text).isin(*NUMBER_WORDS), F.lit(False))


def parse_json_column(text: Column) -> Column:
    """Key/value view of a JSON object; NULL for bad JSON and for non-objects."""
    return F.when(is_json_object(text), F.from_json(text, "map<string,variant>"))


def normalize_timestamp(df: DataFrame, name: str) -> Column:
    """Instant of a timestamp column of any type; NULL when unparseable."""
    col, kind = F.col(name), df.schema[name].dataType.typeName()
    if kind != "string":
        return col.cast("timestamp")
    dated = col.rlike(r"^\d{4}-\d{2}-\d{2}($|[T ])")
    return F.when(dated, F.try_to_timestamp(col))


def iso_text(instant: Column) -> Column:
    """ISO form without offset; the fraction appears only when there is one."""
    whole = F.unix_micros(instant) % 1_000_000 == 0
    return F.when(whole, F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def log_defaults(logs: DataFrame) -> DataFrame:
    missing = {
        name: F.lit(value).cast(kind)
        for name, (value, kind) in COLUMN_DEFAULTS.items()
        if name not in logs.columns
    }
    return logs.withColumns(missing) if missing else logs


def with_row_order(logs: DataFrame) -> DataFrame:
    """Tie-break for rows of a trace that share a timestamp."""
    if "rowSeq" in logs.columns:
        return logs
    return logs.withColumn("rowSeq", F.xxhash64("level", "loggerName", "message", "meta"))


def has_request(method: Column, path: Column) -> Column:
    return F.coalesce(method != "", F.lit(False)) | F.coalesce(path != "", F.lit(False))


def _instant_columns(parsed: Column, as_of: int | Column) -> dict[str, Column]:
    instant = F.coalesce(parsed, F.timestamp_seconds(F.lit(as_of)))
    return {"ls_ts": instant, "ls_ts_unix": F.unix_seconds(instant), "ts_valid": parsed.isNotNull()}


def log_bits(get: Callable[[str], Column], level: Column) -> Column:
    """What is wrong with a log row; ``get`` gives its columns."""
    return (
        error_bit("missing_correlation_id", get("correlationId").isNull())
        + error_bit("invalid_level", level.isNull())
        + error_bit("missing_message", get("message").isNull())
        + error_bit("missing_logger", get("loggerName").isNull())
        + error_bit("invalid_meta", is_json_non_object(get("meta")))
        + error_bit("invalid_exception", is_json_non_object(get("exception")))
    )


def log_context(get: Callable[[str], Column]) -> dict[str, Column]:
    """The trace context as a log row would supply it."""
    request = has_request(get("requestMethod"), get("requestPath"))
    return {
        "project_id": get("projectId"),
        "project_name": get("projectId"),
        "environment": F.lit(""),
        "component": get("loggerName"),
        "started_at": get("sessionStartedAt").cast("string"),
        "ended_at": get("sessionEndedAt").cast("string"),
        "duration_ms": get("durationMs").cast("bigint"),
        "request_method": F.when(request, get("requestMethod")),
        "request_path": F.when(request, get("requestPath")),
        "request_status_code": F.when(request, get("statusCode").cast("int")),
    }


#: Column of tables that have one row per trace, with all its log rows in this list.
PACKED = "packed"


def packed_rows(touched: DataFrame, as_of: int) -> DataFrame:
    """Histories of traces (see ``streaming.history.touched``) for steps that take rows.

    An item is a log row and the time ``at`` which it came; those of ``batch_at`` are in the batch.
    """
    return touched.select(
        F.col("correlationId").alias("correlation_id"), F.col("items").alias(PACKED), "n", "batch_at",
        F.lit(as_of).alias("as_of"),
    )


def is_packed(rows: DataFrame) -> bool:
    return PACKED in rows.columns


def unpacked(rows: DataFrame) -> DataFrame:
    """Canonical rows; of a packed table, those in its lists."""
    if not is_packed(rows):
        return rows
    items = rows.select("as_of", "batch_at", F.explode(PACKED).alias("item"))
    return flat_rows(
        items.select("as_of", (F.col("item.at") == F.col("batch_at")).alias("in_batch"), "item.row.*"), F.col("as_of")
    )


def flat_rows(logs: DataFrame, as_of: int | Column) -> DataFrame:
    """Canonical rows of the flat log table. ``as_of`` replaces unusable times."""
    logs = with_row_order(log_defaults(logs))
    # Values used by several expressions are columns of their own first, so that
    # they are computed once per row.
    logs = logs.withColumns({
        "canonical_level": M.normalize_level(F.col("level")), "lowered": F.lower("message"),
    })
    level = F.col("canonical_level")
    in_batch = F.col("in_batch") if "in_batch" in logs.columns else F.lit(True)
    return logs.select(
        F.col("correlationId").alias("correlation_id"),
        F.col("rowSeq").alias("row_seq"),
        *[c.alias(n) for n, c in
          _instant_columns(normalize_timestamp(logs, "timestamp"), as_of).items()],
        level.alias("level"),
        M.level_rank(level).alias("level_rank"),
        F.col("loggerName").alias("logger_name"),
        "message", "lowered", "meta", "exception",
        log_bits(F.col, level).alias("error_bits"),
        in_batch.alias("in_batch"),
        *[c.alias(n) for n, c in log_context(F.col).items()],
    )


def _lax_integer(text: Column) -> Column:
    value = text.try_cast("double")
    return F.when(value == F.floor(value), F.floor(value))


def nested_rows(traces: DataFrame, as_of: int) -> DataFrame:
    """Canonical rows of already nested traces; a trace without logs has none."""
    duration, status = _lax_integer(F.col("durationMs")), _lax_integer(F.col("request.statusCode"))
    rows = traces.select("*", F.posexplode("logs").alias("pos", "log")).select(
        "*", F.col("log.timestamp").alias("log_ts"),
        M.normalize_level(F.col("log.level")).alias("canonical_level"),
        F.lower("log.message").alias("lowered"),
    )
    level = F.col("canonical_level")
    meta, exception = F.col("log.meta"), F.col("log.exception")

    def not_object(text):
        return text.isNotNull() & ~is_json_object(text)

    bad_integer = (F.col("durationMs").isNotNull() & duration.isNull()) | (
        F.col("request.statusCode").isNotNull() & status.isNull()
    )
    no_project = F.col("project_id").isNull() | F.col("projectName").isNull()
    bits = (
        error_bit("missing_correlation_id", F.col("correlationId").isNull())
        + error_bit("missing_project", no_project)
        + error_bit("invalid_level", level.isNull())
        + error_bit("missing_message", F.col("log.message").isNull())
        + error_bit("missing_logger", F.col("log.loggername").isNull())
        + error_bit("invalid_meta", not_object(meta))
        + error_bit("invalid_exception", not_object(exception))
        + error_bit("invalid_integer", bad_integer)
        + error_bit("missing_started_at", F.col("startedAt").isNull())
        + error_bit("missing_timestamp", F.col("log_ts").isNull())
        + error_bit("missing_environment", F.col("environment").isNull())
    )
    return rows.select(
        F.col("correlationId").alias("correlation_id"),
        F.col("pos").cast("bigint").alias("row_seq"),
        *[c.alias(n) for n, c in
          _instant_columns(normalize_timestamp(rows, "log_ts"), as_of).items()],
        level.alias("level"),
        M.level_rank(level).alias("level_rank"),
        F.col("log.loggername").alias("logger_name"),
        F.col("log.message").alias("message"),
        "lowered",
        meta.alias("meta"),
        exception.alias("exception"),
        bits.alias("error_bits"),
        F.lit(True).alias("in_batch"),
        "project_id",
        F.col("projectName").alias("project_name"),
        "environment",
        "component",
        F.col("startedAt").alias("started_at"),
        F.col("endedAt").alias("ended_at"),
        duration.alias("duration_ms"),
        F.col("request.method").alias("request_method"),
        F.col("request.path").alias("request_path"),
        status.cast("int").alias("request_status_code"),
    )
