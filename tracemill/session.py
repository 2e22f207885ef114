"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The keyword tests make large methods, which the JVM would only interpret;
    # above this size Spark generates them split into small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Traces per task kept in hash maps before an aggregate with lists starts to sort.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
    # The histories of traces (streaming.history) do not fit executors' heaps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, which all executors must share.

    Only a session whose driver and executors are one process may do without the
    setting; it gets a folder of its own for as long as it lives.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tracemill-"))
    return context.getCheckpointDir()


def path_exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def delete_folder(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


class Staging:
    """Intermediate tables, written once so that several consumers share them.

    A staged table has no lineage back to the logs, survives executor loss, and
    its file size gives the optimizer a true size for join decisions. ``clear``
    removes them once what reads them is written.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/staged/{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{self.folder}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        delete_folder(self.spark, self.folder)


def staged(df: DataFrame, label: str) -> DataFrame:
    """One staged table, for callers that keep it."""
    return Staging(df.sparkSession)(df, label)
