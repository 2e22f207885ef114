"""Reading log rows and cutting slices out of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tracemill.schemas import COMMITS, LOGS, RAW_TRACE
from tracemill.session import staged

# Fixed value: the mark before anything was read.
INITIAL_MARK = "1970-01-01 00:00:00.000"
SCAN_ORDER = ("timestamp", "correlationId", "rowSeq")


def scan_logs(spark: SparkSession, path: str, fmt: str = "parquet", schema=LOGS) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def scan_logs_jdbc(
    spark: SparkSession, url: str, table: str, lower: str, upper: str, partitions: int, **options
) -> DataFrame:
    """Parallel scan of a log table behind JDBC, split on ``timestamp``."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="timestamp", lowerBound=lower,
                 upperBound=upper, numPartitions=partitions, **options)
        .load()
    )


def stream_logs(
    spark: SparkSession, path: str, fmt: str = "parquet", schema=LOGS,
    max_files: int | None = None, max_bytes: str | None = None,
) -> DataFrame:
    """The log table as a stream; a micro-batch takes at most so many files or bytes of it."""
    limits = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    given = {name: str(limit) for name, limit in limits.items() if limit is not None}
    return spark.readStream.schema(schema).format(fmt).options(**given).load(path)


def by_project(logs: DataFrame) -> DataFrame:
    """Log rows whose correlation ID is made unique across projects: ``project/id``."""
    both = F.concat_ws("/", "projectId", "correlationId")
    return logs.withColumn("correlationId", F.when(F.col("correlationId").isNotNull(), both))


def scan_raw_traces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_TRACE).json(path)


def scan_commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMMITS).parquet(path)


def _bound(df: DataFrame, value):
    return F.lit(value).cast(df.schema["timestamp"].dataType)


def incremental_filter(logs: DataFrame, after: str, upto: str | None = None) -> DataFrame:
    """Rows after the mark, up to and including the cutoff."""
    rows = logs.where(F.col("timestamp") > _bound(logs, after))
    return rows if upto is None else rows.where(F.col("timestamp") <= _bound(logs, upto))


def batch_slice(logs: DataFrame, size: int) -> DataFrame:
    """The next ``size`` rows in scan order. Meant for bounded polling slices."""
    return logs.orderBy(*SCAN_ORDER).limit(size)


def trim_split_tail(rows: DataFrame, size: int) -> DataFrame:
    """Drop the last trace of a full slice, which the limit may have split.

    A slice that is all one trace stays, or polling would never advance. A slice
    is one task of at most ``size`` rows already, so its ends are looked up in a
    window over it rather than by reading it again.
    """
    scan_key = F.struct(*SCAN_ORDER)
    slice_ = Window.partitionBy()
    ends = {
        "slice_rows": F.count("*").over(slice_),
        "slice_head": F.min_by("correlationId", scan_key).over(slice_),
        "slice_tail": F.max_by("correlationId", scan_key).over(slice_),
    }
    in_tail = F.col("correlationId").eqNullSafe(F.col("slice_tail"))
    whole = (F.col("slice_rows") < size) | F.col("slice_head").eqNullSafe(F.col("slice_tail"))
    return rows.withColumns(ends).where(whole | ~in_tail).select(*rows.columns)


def rows_of_traces(logs: DataFrame, wanted: DataFrame) -> DataFrame:
    """All rows of the wanted correlation IDs, whatever the mark."""
    return logs.join(wanted.select("correlationId"), "correlationId", "left_semi")


def high_water_mark(rows: DataFrame, current: str) -> DataFrame:
    mark = F.coalesce(F.max("timestamp"), _bound(rows, current))
    return rows.agg(mark.alias("mark"))


def safe_high_water_mark(rows: DataFrame, current: str, failed: DataFrame) -> DataFrame:
    """Timestamp of the last row before the first row of any failed trace."""
    scan_key = F.struct(*SCAN_ORDER)
    failed_ids = failed.select("correlationId").distinct()
    stop = (
        rows.join(failed_ids, "correlationId", "left_semi")
        .agg(F.min(scan_key).alias("stop"))
        .scalar()
    )
    return high_water_mark(rows.where(stop.isNull() | (scan_key < stop)), current)


def latest_commit(commits: DataFrame) -> DataFrame:
    return commits.groupBy("project_id").agg(F.max("timestamp_unix").alias("timestamp_unix"))


def batch_row_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("correlationId").agg(F.count("*").alias("n"))


def total_row_counts(logs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows per wanted correlation ID in the whole table."""
    return batch_row_counts(rows_of_traces(logs, wanted))


def partial_traces(batch: DataFrame, logs: DataFrame) -> DataFrame:
    """(correlationId, n, total): traces with more rows in the table than in the batch.

    Both tables are counted by one aggregate, which shrinks them before they move; a join would
    shuffle and sort every row of the table, or send all of them through the driver.
    """
    both = batch.select("correlationId", F.lit(1).alias("own")).unionByName(
        logs.select("correlationId", F.lit(0).alias("own"))
    )
    counted = both.where(F.col("correlationId").isNotNull()).groupBy("correlationId").agg(
        F.sum("own").alias("n"), F.sum(1 - F.col("own")).alias("total")
    )
    return counted.where((F.col("n") > 0) & (F.col("total") > F.col("n")))


def refetch_partial_traces(batch: DataFrame, logs: DataFrame, stage=staged) -> DataFrame:
    """The batch with each partial trace replaced by its full history.

    ``in_batch`` marks the rows that were in the batch itself; a trace with any
    other row is a merge, and its place in the batch order comes from the
    ``in_batch`` rows. Rows need no key: what the batch lacks of a trace's history
    is the difference of the two as bags, so that repeated lines keep their number.

    The partial traces are staged: they are mostly few, and rows are then picked by them
    where they are read. Both tables are one input of one aggregate, so that a task has
    the sorters and maps of one join and not those of a join a side.
    """
    partial = stage(partial_traces(batch, logs).select("correlationId"), "partial")
    both = logs.select(*batch.columns, F.lit(1).alias("_copies")).unionByName(
        batch.withColumn("_copies", F.lit(-1))
    )
    lacking = rows_of_traces(both, partial).groupBy(*batch.columns).agg(F.sum("_copies").alias("_copies"))
    refetched = lacking.where("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))
    ).select(*batch.columns)
    return batch.withColumn("in_batch", F.lit(True)).unionByName(
        refetched.withColumn("in_batch", F.lit(False))
    )
