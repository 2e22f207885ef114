"""Log rows and commits derived from the ``events`` table.

The SQL runs unchanged in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# 2024-01-31 00:00:00 UTC, the evaluation time of every query.
AS_OF = 1706659200

LOGS_SQL = """
SELECT event_id AS rowSeq,
  'proj-' || CAST(user_id % 3 AS STRING) AS projectId,
  'cid-' || CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS correlationId,
  ts AS timestamp,
  CASE WHEN event_id % 499 = 0 THEN 'trace'
       WHEN event_type = 'error' AND k < 8 THEN 'CRITICAL'
       WHEN event_type = 'error' AND k < 40 THEN 'Error'
       WHEN k BETWEEN 90 AND 92 THEN 'WARNING'
       WHEN event_id % 7 = 0 THEN 'debug' ELSE 'INFO' END AS level,
  CASE event_id % 4 WHEN 0 THEN 'gateway' WHEN 1 THEN 'auth' WHEN 2 THEN 'orders' ELSE '' END
    AS loggerName,
  CASE WHEN event_type = 'error' AND k < 40
         THEN 'TimeoutError: upstream 10.0.0.' || CAST(k AS STRING) || ':8080 silent for '
              || CAST(event_id AS STRING) || ' ms at 0x' || CAST(1000 + k AS STRING)
       WHEN user_id = 7 AND event_type <> 'error'
         THEN 'req-' || CAST(event_id AS STRING) || 'x: step done'
       WHEN k = 52 THEN repeat('long dump of state ', 150) || CAST(event_id AS STRING)
       WHEN k = 50 THEN 'Retrying call ' || CAST(event_id AS STRING) || ', fallback used'
       WHEN k = 51 THEN '12:30 clock tick'
       ELSE 'User ' || CAST(user_id AS STRING) || ' did ' || event_type END AS message,
  CASE WHEN event_id % 997 = 0 THEN '[1]' WHEN event_id % 5 = 0 THEN props
       WHEN event_id % 5 = 1 THEN 'not json'
       WHEN event_id % 25 = 3 THEN '{"items":["a",1,true,null],"many":[1,2,3,4,5,6,7],"nested":{"x":[1]},"empty":[],"none":null}'
       WHEN event_id % 5 = 2 THEN '{"order":"A-' || CAST(k AS STRING) || '","flag":true}' END
    AS meta,
  CAST(NULL AS STRING) AS exception,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS sessionStartedAt,
  CAST(NULL AS TIMESTAMP) AS sessionEndedAt,
  CAST(FLOOR(value * 10) AS BIGINT) AS durationMs,
  CASE WHEN user_id % 5 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'GET' ELSE 'POST' END
    AS requestMethod,
  CASE WHEN user_id % 5 = 0 THEN NULL
       WHEN user_id % 4 = 0 THEN '/users/' || CAST(user_id AS STRING) || '/orders'
       WHEN user_id % 4 = 1 THEN '/orders/ORD-' || CAST(user_id AS STRING)
       ELSE '/api/v2/products' END AS requestPath,
  CASE user_id % 11 WHEN 0 THEN 503 WHEN 1 THEN 404 ELSE 200 END AS statusCode
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e
"""

# One project with commits up to the evaluation time, one with older commits only.
COMMITS_SQL = f"""
SELECT 'proj-' || CAST(user_id % 3 AS STRING) AS project_id,
  CAST({AS_OF} - (user_id % 3) * 7200 - 60 * (event_id % 500) AS BIGINT) AS timestamp_unix
FROM events WHERE user_id % 3 < 2 AND event_id % 10 = 0
"""

# Commits of every project all through the month.
COMMIT_HISTORY_SQL = f"""
SELECT 'proj-' || CAST(user_id % 3 AS STRING) AS project_id,
  CAST({AS_OF} - (event_id * 7919) % 2592000 AS BIGINT) AS timestamp_unix
FROM events WHERE event_id % 20 = 0
"""


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _events(spark, sf_dir)
    return spark.sql(LOGS_SQL)


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    _events(spark, sf_dir)
    return spark.sql(COMMITS_SQL)


def commit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    _events(spark, sf_dir)
    return spark.sql(COMMIT_HISTORY_SQL)


def _events(spark: SparkSession, sf_dir: str) -> None:
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("events")
