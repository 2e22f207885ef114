"""Table schemas."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STR, INT, LONG, BOOL, TS = (
    T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType()
)
STRINGS = T.ArrayType(STR)


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


LOGS = table(
    rowSeq=LONG, projectId=STR, correlationId=STR, timestamp=TS, level=STR, loggerName=STR,
    message=STR, meta=STR, exception=STR, sessionStartedAt=TS, sessionEndedAt=TS,
    durationMs=LONG, requestMethod=STR, requestPath=STR, statusCode=INT,
)

# Numbers arrive as text so that integral strings and floats can be accepted
# and fractions rejected (see operators.rows.nested_rows).
RAW_TRACE = table(
    projectName=STR, project_id=STR, environment=STR, correlationId=STR, component=STR,
    startedAt=STR, endedAt=STR, durationMs=STR,
    request=table(method=STR, path=STR, statusCode=STR),
    logs=T.ArrayType(table(
        timestamp=STR, level=STR, message=STR, meta=STR, loggername=STR, exception=STR,
    )),
)

COMMITS = table(project_id=STR, timestamp_unix=LONG)

DOCUMENTS = table(
    project_id=STR, correlation_id=STR, project_name=STR, semantic_text=STR,
    request_method=STR, request_path=STR, request_path_pattern=STR, request_status_code=INT,
    services=STRINGS, max_level=STR, outcome=STR, severity_score=INT, fingerprint=STR,
    has_errors=BOOL, has_warnings=BOOL, log_count=LONG, levels_present=STRINGS,
    environment=STR, duration_ms=LONG, timestamp_unix=LONG,
    error_types=STRINGS, suspicious_keywords=STRINGS,
    occurrence_count=LONG, last_seen=LONG, entered_at=TS, embedding=T.ArrayType(T.FloatType()),
)

QUARANTINE = table(correlation_id=STR, count=LONG, last_error=STR, first_seen=TS, last_seen=TS)
FAILURES = table(correlation_id=STR, error=STR, seen=TS)
REMOVED = table(project_id=STR, correlation_id=STR)
REPEATS = table(project_id=STR, correlation_id=STR, n=LONG, seen=LONG)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table known to be empty, so the optimizer drops the joins with it."""
    columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
    return spark.sql(f"SELECT {', '.join(columns)} WHERE false")
