"""Nested traces as a stream of JSON lines; a broken line costs itself alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tracemill import schemas as S
from tracemill.config import EngineConfig
from tracemill.operators import documents as D
from tracemill.operators.rows import nested_rows
from tracemill.operators.traces import failed_traces, trace_features, valid_traces
from tracemill.session import Staging, apply_settings

#: Holds a line that is no JSON object; null for all others.
BROKEN = "broken_line"
INVALID_JSON = "invalid_json"
RECORDS = T.StructType([*S.RAW_TRACE.fields, T.StructField(BROKEN, S.STR)])
REJECTED = S.table(correlation_id=S.STR, error=S.STR, record=S.STR)


def stream_raw_traces(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    limits = {} if max_files is None else {"maxFilesPerTrigger": str(max_files)}
    reader = spark.readStream.schema(RECORDS).option("columnNameOfCorruptRecord", BROKEN)
    return reader.options(**limits).json(path)


class NestedStore:
    """Documents and rejected records, one ``batch_id=N`` folder per micro-batch and table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, name: str, batch_id: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")

    def documents(self) -> DataFrame:
        """The latest document of each trace: one that arrives again replaces the first."""
        columns = [f for f in S.DOCUMENTS.fields if f.name not in ("entered_at", "embedding")]
        schema = T.StructType([*columns, T.StructField("batch_id", S.LONG)])
        stored = self.spark.read.schema(schema).parquet(f"{self.path}/documents")
        document = F.struct(*[f.name for f in columns]).alias("document")
        return stored.select("batch_id", document).groupBy("document.project_id", "document.correlation_id").agg(
            F.max_by("document", "batch_id").alias("document")
        ).select("document.*")

    def rejected(self) -> DataFrame:
        schema = T.StructType([*REJECTED.fields, T.StructField("batch_id", S.LONG)])
        return self.spark.read.schema(schema).parquet(f"{self.path}/rejected")


def process_records(store: NestedStore, records: DataFrame, batch_id: int, as_of: int, cfg: EngineConfig) -> None:
    """Documents of the valid traces; broken lines and failed traces are kept with their error."""
    staging = Staging(store.spark)
    try:
        read = staging(records, "records")
        whole = read.where(F.col(BROKEN).isNull()).drop(BROKEN)
        rows = nested_rows(whole, as_of)
        features = staging(trace_features(rows, cfg), "features")
        documents = D.trace_documents(valid_traces(features), rows, cfg)
        store.write("documents", batch_id, documents.drop("entered_at"))
        failed = failed_traces(features).withColumn("record", F.lit(None).cast("string"))
        broken = read.where(F.col(BROKEN).isNotNull()).select(
            F.lit(None).cast("string").alias("correlation_id"), F.lit(INVALID_JSON).alias("error"), F.col(BROKEN).alias("record")
        )
        store.write("rejected", batch_id, failed.unionByName(broken))
    finally:
        staging.clear()


def run_nested(
    records: DataFrame, store: NestedStore, as_of: Callable[[int], int], cfg: EngineConfig | None = None
) -> StreamingQuery:
    """Drain a stream of nested traces without a gate."""
    cfg = cfg or EngineConfig.standalone()
    apply_settings(store.spark)

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_records(store, batch, batch_id, as_of(batch_id), cfg)

    writer = records.writeStream.foreachBatch(handle).option("checkpointLocation", f"{store.path}/checkpoint")
    return writer.trigger(availableNow=True).start()
