"""Small hand-made inputs."""

from __future__ import annotations

from datetime import datetime, timedelta

from tracemill import schemas as S
from tracemill.operators.rows import flat_rows
from tracemill.plans.batch import run_batch

AS_OF = 1706659200
START = datetime(2024, 1, 5, 10, 0, 0)


def log(cid, message, level="INFO", logger="orders", at=0, project="p", method=None, path=None,
        status=None, duration=None, meta=None, exception=None, seq=None, timestamp=...):
    moment = START + timedelta(seconds=at) if timestamp is ... else timestamp
    return (seq if seq is not None else at, project, cid, moment, level, logger, message, meta,
            exception, None, None, duration, method, path, status)


def logs_frame(spark, entries):
    return spark.createDataFrame(entries, S.LOGS)


def commits_frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), S.COMMITS)


def document(project, cid, fingerprint, path=None, count=1, at=START - timedelta(days=1)):
    values = dict.fromkeys(S.DOCUMENTS.names)
    values.update(project_id=project, correlation_id=cid, fingerprint=fingerprint,
                  request_path_pattern=path, occurrence_count=count, last_seen=1, entered_at=at)
    return tuple(values[name] for name in S.DOCUMENTS.names)


def documents_frame(spark, *documents):
    return spark.createDataFrame(list(documents), S.DOCUMENTS)


def batch(spark, entries, documents=(), commits=(), quarantine=(), **options):
    rows = entries if not isinstance(entries, list) else flat_rows(logs_frame(spark, entries), AS_OF)
    return run_batch(
        rows, documents_frame(spark, *documents), commits_frame(spark, *commits),
        spark.createDataFrame(list(quarantine), S.QUARANTINE), AS_OF, **options,
    )


def by_cid(df):
    return {row["correlation_id"]: row for row in df.collect()}
