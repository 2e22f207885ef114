"""Stored documents in hash buckets of (project, fingerprint).

A batch that looks up fingerprints shuffles its own keys to the buckets; the store, which grows
with age, is read where it lies and sorted as it is. The table is external: files are the
state, and a session that does not know it yet registers it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.schemas import DOCUMENTS

BUCKET_KEY = ("project_id", "fingerprint")


def write_buckets(documents: DataFrame, table: str, path: str, buckets: int) -> None:
    """Append documents, one file per bucket."""
    typed = documents.select(*[F.col(f.name).cast(f.dataType) for f in DOCUMENTS])
    typed.repartition(buckets, *BUCKET_KEY).write.mode("append").format("parquet").bucketBy(
        buckets, *BUCKET_KEY
    ).sortBy(*BUCKET_KEY).option("path", path).saveAsTable(table)


def open_buckets(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DOCUMENTS)
        key = ", ".join(BUCKET_KEY)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key})"
            f" INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(table)
