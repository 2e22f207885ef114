"""Column expressions over one trace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracemill.functions.messages import ERROR_RANK, WARN_RANK, normalize_message, unicode_aware

# Severity of a trace by its highest level, and the boosts.
BASE_SEVERITY = {"debug": 1, "info": 2, "warn": 4, "error": 7, "fatal": 9}
CRITICAL_BOOST = 2
FAILURE_BOOST = 1
MAX_SEVERITY = 10
FAILED_OUTCOMES = ("server_error", "failure")

# A path segment that is an identifier.
ID_SEGMENT = r"(\d+|[0-9a-fA-F-]{8,}|[A-Za-z]+-\d+|[A-Za-z0-9]{20,})"
ID_PLACEHOLDER = "{id}"

# Fingerprint format.
FINGERPRINT_PREFIX = "TRC-"
SERVICE_ARROW = "→"


def classify_outcome(status: Column, max_rank: Column) -> Column:
    return (
        F.when(max_rank >= ERROR_RANK, "failure")
        .when(status >= 500, "server_error")
        .when(status >= 400, "client_error")
        .when(max_rank == WARN_RANK, "warning")
        .otherwise("success")
    )


def trace_severity(max_level: Column, outcome: Column, has_critical: Column) -> Column:
    base = F.lit(BASE_SEVERITY["info"])
    for level, score in BASE_SEVERITY.items():
        base = F.when(max_level == level, score).otherwise(base)
    boosted = F.least(base + F.when(has_critical, CRITICAL_BOOST).otherwise(0), F.lit(MAX_SEVERITY))
    failed = F.when(outcome.isin(*FAILED_OUTCOMES), FAILURE_BOOST).otherwise(0)
    return F.least(boosted + failed, F.lit(MAX_SEVERITY))


def normalize_request_path(path: Column) -> Column:
    """Endpoint pattern: whole segments that look like identifiers are replaced."""
    pattern = unicode_aware(rf"(?<=^|/){ID_SEGMENT}(?=/|$)")
    return F.when(path != "", F.regexp_replace(path, pattern, ID_PLACEHOLDER))


def trace_fingerprint(services: Column, max_level: Column, message: Column) -> Column:
    flow = F.array_join(F.sort_array(F.array_distinct(services)), SERVICE_ARROW)
    raw = F.concat_ws("|", flow, max_level, normalize_message(message))
    return F.concat(F.lit(FINGERPRINT_PREFIX), F.upper(F.substring(F.md5(raw), 1, 8)))
