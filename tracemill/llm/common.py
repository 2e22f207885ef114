"""Helpers shared by the text operators: checkpoints, batches, class labels over links."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.session import delete_folder

#: Bytes of text that a task hashes at once; numpy needs about 100 times this for its arrays.
BATCH_BYTES = 1 << 18
#: Rows that pass between Spark and a Python worker at once.
BATCH_ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; only a local session may do without the setting."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def small_batches(spark: SparkSession) -> None:
    """Batches of so few rows that neither Spark nor a Python worker holds much text at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Returns to the system what this process has freed: Arrow and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(work: Batches) -> Batches:
    """`work` of a task, after which its Python worker holds no memory that it does not use.

    Workers outlive their tasks. A stage with several Python steps has several of them for each
    core, and the idle ones stay in the executor's memory while later steps run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept where a lost executor cannot take them away."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Tables:
    """Parquet tables in the shared folder: computed once, safe from lost executors, and deleted
    by `drop` as soon as what was made of them is written."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = path
        return kept

    def drop(self, *kept: DataFrame) -> None:
        for df in kept:
            delete_folder(self.spark, self.paths.pop(id(df)))


def text_batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with about BATCH_BYTES of UTF-8 text each; null texts are empty."""
    texts = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    until = np.cumsum(sizes)
    start = 0
    while start < len(batch):
        done = until[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(until, done + BATCH_BYTES)))
        part = batch.slice(start, stop - start)
        yield part, [value or b"" for value in texts.slice(start, stop - start).cast(pa.binary()).to_pylist()]
        start = stop


#: Cells of one row that Spark's bitmap aggregate returns.
BITMAP_CELLS = 1 << 15
#: Bits of a bitmap of row keys: 8 MB, whatever the table's size.
KEY_BITS = 26


def bitmap(cells: DataFrame, size: int) -> bytes:
    """The column `cell` of `cells` as a bitmap of `size` bits, which is what the driver receives."""
    parts = cells.groupBy((F.col("cell") / BITMAP_CELLS).cast("int").alias("block")).agg(
        F.bitmap_construct_agg((F.col("cell") % BITMAP_CELLS).cast("long")).alias("bits")
    )
    merged = bytearray(size // 8 or 1)
    for block, part in parts.toLocalIterator():
        at = block * BITMAP_CELLS // 8
        merged[at : at + len(part)] = part[: len(merged) - at]
    return bytes(merged)


def in_bitmap(raw: bytes, cells: np.ndarray) -> np.ndarray:
    return (np.frombuffer(raw, np.uint8)[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)


def by_bitmap(df: DataFrame, cell: str, raw: Broadcast, wanted: bool) -> DataFrame:
    """Rows whose column `cell` is in the bitmap, or is not.

    A join on the key itself must follow where it matters: other keys may share a cell. The
    point is that rows without a match need not be shuffled for that join.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here = in_bitmap(raw.value, batch.column(cell).to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array(here == wanted))

    return df.mapInArrow(giving_back(pick), df.schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with the given ones that do not clash with those of `df`."""
    taken = {name.lower() for name in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def smallest_reachable(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, label): the smallest node that undirected `links` (a, b) reach from each node.

    Alternates two star contractions: every node's larger neighbours, then its smaller ones,
    are hung on its smallest neighbour. Both are joins on a node with a grouped minimum, so
    that a hub shrinks before it is shuffled; the number of rounds grows with the logarithm
    of the longest chain. The links stay on executors throughout, and on disk only those of
    the last round.
    """
    tables = Tables(links.sparkSession)
    edges = tables.keep(links.select("a", "b").where("a <> b").distinct())
    state = None
    for _ in range(rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(
            least.select("a", F.col("m").alias("b"))
        )
        before, edges = edges, tables.keep(small.distinct())
        tables.drop(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label"))
            ).distinct()
        state = now
    raise RuntimeError("links did not settle")
