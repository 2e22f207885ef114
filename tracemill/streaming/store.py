"""State of the streaming job as plain Parquet tables.

Each micro-batch owns one ``batch_id=N`` folder per table and rewrites only
that, so a replayed batch replaces its own output and changes nothing else.
Writes are proportional to the batch, not to the state: a document that is
removed or seen again gets a row in ``removed`` or ``repeats``, and readers
combine the three. The rows of traces are not here: the job's state store has
them (see ``history``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill import schemas as S
from tracemill.operators.documents import DOCUMENT_KEY

SEEN = S.table(correlationId=S.STR, n=S.LONG)
STARTED = S.table(as_of=S.LONG)
METRICS = S.table(promoted=S.LONG, dropped=S.LONG, failed=S.LONG, total=S.LONG, tripped=S.BOOL)

# Table -> (schema, partition columns below batch_id).
TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "seen": (SEEN, ()),
    "started": (STARTED, ()),
    "documents": (S.DOCUMENTS, ("project_id",)),
    "removed": (S.REMOVED, ()),
    "repeats": (S.REPEATS, ()),
    "failures": (S.FAILURES, ()),
    "metrics": (METRICS, ()),
}


class TraceStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def create(self) -> "TraceStore":
        """Create missing tables; existing ones are left alone."""
        for name in TABLES:
            empty = self.spark.createDataFrame([], self._schema(name))
            empty.write.mode("ignore").partitionBy("batch_id").parquet(self._path(name))
        return self

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    def _path(self, name: str) -> str:
        return f"{self.path}/{name}"

    @staticmethod
    def _schema(name: str) -> T.StructType:
        extra = [T.StructField("batch_id", S.LONG)]
        if name == "failures":
            extra.append(T.StructField("attempt", S.INT))
        return T.StructType([*TABLES[name][0].fields, *extra])

    def write(self, name: str, batch_id: int, df: DataFrame, attempt: int = 0) -> None:
        schema, parts = TABLES[name]
        typed = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        if parts:
            # Adaptive execution splits a hot project and merges tiny ones.
            typed = typed.hint("rebalance", *parts)
        folder = f"{self._path(name)}/batch_id={batch_id}"
        if name == "failures":
            folder = f"{folder}/attempt={attempt}"
        typed.write.mode("overwrite").partitionBy(*parts).parquet(folder)

    def read(self, name: str, before: int | None = None) -> DataFrame:
        """Rows of earlier batches; of all batches without ``before``."""
        df = self.spark.read.schema(self._schema(name)).parquet(self._path(name))
        return df if before is None else df.where(F.col("batch_id") < before)

    def as_of(self, batch_id: int, now: int) -> int:
        """The evaluation time of a batch: that of its first attempt, ``now`` if this is it."""
        first = self.batch("started", batch_id).first()
        if first is not None:
            return first.as_of
        self.write("started", batch_id, self.spark.range(1).select(F.lit(now).alias("as_of")))
        return now

    def counts(self) -> DataFrame:
        """Rows taken in per correlation ID and batch."""
        return self.read("seen").select("correlationId", "n")

    def failures(self, batch_id: int) -> DataFrame:
        """Failures known when a batch is evaluated: earlier batches and its halted attempts."""
        return self.read("failures").where(
            (F.col("batch_id") < batch_id)
            | ((F.col("batch_id") == batch_id) & (F.col("attempt") > 0))
        )

    def halted_attempts(self, batch_id: int) -> int:
        attempts = self.failures(batch_id).where(F.col("batch_id") == batch_id)
        return attempts.agg(F.coalesce(F.max("attempt"), F.lit(0))).first()[0]

    def batch(self, name: str, batch_id: int) -> DataFrame:
        return self.read(name).where(F.col("batch_id") == batch_id).drop("batch_id")

    def committed(self) -> DataFrame:
        """Finished batches; ``metrics`` is written last."""
        return self.read("metrics")

    def live_documents(self, before: int | None = None) -> DataFrame:
        """Stored documents that no later batch removed, counts as first written.

        Documents are not grouped, so that a reader shuffles only the columns it needs, and
        none where the removed keys are few enough to be broadcast by Spark.
        """
        last_removed = self.read("removed", before).groupBy(*DOCUMENT_KEY).agg(
            F.max("batch_id").alias("removed_in")
        )
        gone = F.coalesce(F.col("removed_in") > F.col("batch_id"), F.lit(False))
        documents = self.read("documents", before)
        return documents.join(last_removed, DOCUMENT_KEY, "left").where(~gone).drop("removed_in")

    def documents(self, before: int | None = None) -> DataFrame:
        """Live documents with their occurrence counts."""
        live = self.live_documents(before)
        repeats = self.read("repeats", before).withColumnRenamed("batch_id", "repeated_in")
        # Repeats of a document that was replaced later do not carry over.
        counted = (
            live.select(*DOCUMENT_KEY, "batch_id")
            .join(repeats, DOCUMENT_KEY)
            .where(F.col("repeated_in") >= F.col("batch_id"))
            .groupBy(*DOCUMENT_KEY)
            .agg(F.sum("n").alias("n"), F.max("seen").alias("seen"))
        )
        return (
            live.join(counted, DOCUMENT_KEY, "left")
            .withColumns({
                "occurrence_count": F.col("occurrence_count") + F.coalesce("n", F.lit(0)),
                "last_seen": F.coalesce("seen", "last_seen"),
            })
            .select(*S.DOCUMENTS.names)
        )
