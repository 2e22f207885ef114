"""What came earlier of the traces that a micro-batch touches, kept by correlation ID.

A trace whose rows arrive in several micro-batches is evaluated again as a whole. Its earlier
rows are the state of its correlation ID in Spark's state store, so that a micro-batch reads the
histories it touches and nothing else, however long the job has been running. The state belongs
to the checkpoint: a batch that runs again finds the state of the batch before it.

The state is a streaming aggregate, which a task reads and writes without leaving Spark: most
traces have a few rows, and a call to another process for each of them takes far longer than
the rows themselves. Rows are held as they are, with the types of their columns: writing them
as text and reading them back costs as much as evaluating them. A state is one value, so a
trace's rows have to fit an executor's heap together; `APPENDED` deals those of very long
traces out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill import schemas as S
from tracemill.operators.rows import log_defaults, with_row_order

#: For copies of stored rows as JSON, which keeps microseconds only if told to.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
#: Lists that the rows of a trace are appended to, by their hash. Each list is a state and a row
#: of its own, and a touched trace reads them all. A checkpoint keeps the number it began with.
APPENDED = 1


def arrived(logs: DataFrame) -> DataFrame:
    """Rows of any log table with the columns and types of ``LOGS``."""
    full = with_row_order(log_defaults(logs))
    return full.select(*[F.col(f.name).cast(f.dataType) for f in S.LOGS])


def with_history(logs: DataFrame) -> DataFrame:
    """A stream of log rows, each touched trace with its earlier rows; ``in_batch`` marks the new ones."""
    rows = touched(logs).select("batch_at", F.explode("items").alias("item")).select(
        "item.row", (F.col("item.at") == F.col("batch_at")).alias("in_batch")
    )
    return rows.select("row.*", "in_batch")


def touched(logs: DataFrame) -> DataFrame:
    """(correlationId, items, n, own, batch_at): the rows of each trace that a micro-batch touches, as a list.

    For an update-mode query. An item is a ``row`` and the time ``at`` of its micro-batch, which a batch
    that runs again keeps, so that those of the current one, ``own`` in number, are told from earlier
    ones. With more than one list (see `APPENDED`) a trace has a row for each that is not empty.
    """
    packed = arrived(logs).select(
        "correlationId", F.struct(F.current_timestamp().alias("at"), F.struct(*S.LOGS.names).alias("row")).alias("item")
    )
    own = F.pmod(F.xxhash64("item.row"), F.lit(APPENDED))
    lists = F.array(F.lit(0)) if APPENDED == 1 else F.sequence(F.lit(0), F.lit(APPENDED - 1))
    dealt = packed.withColumn("list", F.explode(lists)).withColumn("item", F.when(F.col("list") == own, F.col("item")))
    lists = dealt.groupBy("correlationId", "list").agg(F.collect_list("item").alias("items"), F.count("item").alias("n"))
    now = F.current_timestamp()
    return lists.where("n > 0").select(
        "correlationId", "items", "n", F.size(F.filter("items", lambda i: i["at"] == now)).alias("own"), now.alias("batch_at")
    )


def stored_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(correlationId, n): rows that the state of a job holds, as of its last finished batch."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.groupBy(F.col("key.correlationId").alias("correlationId")).agg(F.sum("value.count").alias("n"))
