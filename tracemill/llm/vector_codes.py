"""Compression of vectors to codes: one codebook entry per part of a vector, fitted exactly.

Components become whole numbers, floor(4096 x), and vectors are cut into `parts` equal pieces.
All pieces of one part are sorted along a Hilbert curve and stored as flat blocks of up to
BLOCK neighbours, each with the box that holds them (smallest and largest component) and their
sums. In a round, a block keeps the entries whose distance to the box is not above the smallest
distance within which some entry has the whole box. If one is left, it takes the block by its
sums, and no piece is looked at; otherwise a small kernel in whole numbers compares the pieces
with the entries on that list alone. An entry that is dropped is farther from every piece than
another one, so codes, ties included, are those of comparing everything.

The codebooks, `parts` x `entries` pieces, are all that travels between driver and tasks, as
sums one way and as entries the other. Blocks are written once; rounds only read them.

Defined results: a row whose vector is null or holds null or non-finite components is dropped.
Components beyond LIMIT / 4096 count as that. Shorter vectors count as if zeros followed, up to the
longest one, and so do lengths that `parts` does not divide. The first codebook comes from the
rows with the smallest ids, null last, equal ids by their components; with fewer rows than
entries there are fewer entries. Equal rows have codes of their own. An empty table gives no
rows. Only `vec_id`, `embedding` and `label` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.llm.common import checkpointed
from tracemill.llm.hilbert import PLACE_BITS, places

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
#: Largest size of a whole component: distances over 1000 components then fit a long.
LIMIT = 1 << 25
#: Pieces and components of one block, at most.
BLOCK, BLOCK_COMPONENTS = 128, 2048
#: Coded pieces that are handed on at once.
CODED_PIECES = 8192

BLOCKS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("rows", T.ArrayType(T.LongType())),
    T.StructField("low", T.ArrayType(T.LongType())), T.StructField("high", T.ArrayType(T.LongType())),
    T.StructField("sums", T.ArrayType(T.LongType())), T.StructField("pieces", T.BinaryType()),
])


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, whole): usable rows with their components as whole numbers."""
    scaled = F.transform("embedding", lambda x: F.least(F.greatest(
        F.floor(x.cast("double") * SCALE), F.lit(-LIMIT)), F.lit(LIMIT)).cast("int"))
    return vectors.where(usable(F.col("embedding"))).select("vec_id", "label", scaled.alias("whole"))


def cut_blocks(whole: DataFrame, width: int, parts: int) -> DataFrame:
    """Blocks of pieces that are neighbours on the curve of their part.

    `whole` is (row, whole); `width` is the length of a piece.
    """
    spread = whole.select(F.posexplode("whole").alias("i", "x")).groupBy("i").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    low, high = np.zeros(width * parts, np.int64), np.zeros(width * parts, np.int64)
    for r in spread.collect():  # one row per component
        low[r["i"]], high[r["i"]] = r["low"], r["high"]
    # A row of its own for every piece; components beyond a vector's end are 0.
    low, high = np.minimum(low, 0), np.maximum(high, 0)
    axes = min(width, PLACE_BITS)
    bits = min(8, PLACE_BITS // max(axes, 1))
    step = max(1, min(BLOCK, BLOCK_COMPONENTS // max(width, 1)))
    pieces = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()),
        T.StructField("row", T.LongType()), T.StructField("piece", T.BinaryType()),
    ])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = padded(batch.column("whole"), width * parts)
            row = batch.column("row")
            for part in range(parts):
                at = slice(part * width, (part + 1) * width)
                piece, least = matrix[:, at], low[at]
                cells = (piece - least) * (1 << bits) // (high[at] - least + 1)
                place = places(cells[:, :axes], bits) if axes else np.zeros(len(batch), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(batch), part, np.int32)), pa.array(place), row, binaries(piece)], names=pieces.names
                )

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            matrix = pieces_of(batch.column("piece").to_pylist(), width)
            rows = batch.column("row").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
            starts = np.concatenate([np.arange(a, b, step) for a, b in zip(edges[:-1], edges[1:])])
            held = [slice(a, b) for a, b in zip(starts, [*starts[1:], len(part)])]
            yield pa.RecordBatch.from_pylist([
                {"part": int(part[s.start]), "rows": rows[s], "low": matrix[s].min(0), "high": matrix[s].max(0),
                 "sums": matrix[s].sum(0), "pieces": matrix[s].astype("<i4").tobytes()} for s in held
            ], schema=ARROW_BLOCKS)

    dealt = whole.mapInArrow(deal, pieces).repartitionByRange("part", "place", "row").sortWithinPartitions("part", "place", "row")
    return dealt.mapInArrow(block, BLOCKS)


ARROW_BLOCKS = pa.schema([
    ("part", pa.int32()), ("rows", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())),
    ("sums", pa.list_(pa.int64())), ("pieces", pa.binary()),
])


def padded(lists: pa.Array, size: int) -> np.ndarray:
    """Rows of `lists` as a matrix, zeros after the end of a short one."""
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if (lengths == size).all():
        return values.reshape(len(lists), size).astype(np.int64)
    out = np.zeros((len(lists), size), np.int64)
    out[np.arange(size) < lengths[:, None]] = values
    return out


def binaries(matrix: np.ndarray) -> pa.Array:
    flat, step = np.ascontiguousarray(matrix, "<i4"), matrix.shape[1] * 4
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * step
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def pieces_of(raw: list[bytes], width: int) -> np.ndarray:
    count = sum(map(len, raw)) // (4 * width) if width else len(raw)
    return np.frombuffer(b"".join(raw), "<i4").reshape(count, width).astype(np.int64)


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(blocks, entries): which entries may be nearest to a piece inside a block's box."""
    below, above = low[:, None] - entries, entries - high[:, None]
    near = (np.maximum(np.maximum(below, above), 0) ** 2).sum(2)
    far = (np.maximum(high[:, None] - entries, entries - low[:, None]) ** 2).sum(2)
    return near <= far.min(1, keepdims=True)


def nearest(pieces: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each piece's nearest entry, the lower index on ties."""
    best = np.zeros(len(pieces), np.int64)
    least = ((pieces - entries[0]) ** 2).sum(1)
    for index in range(1, len(entries)):
        here = ((pieces - entries[index]) ** 2).sum(1)
        closer = here < least
        best[closer], least[closer] = index, here[closer]
    return best, least


def _blocks(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(place in the batch, part, entries on the list) of each block."""
    width = books.shape[2]
    part = batch.column("part").to_numpy()
    low, high = (batch.column(c).flatten().to_numpy().reshape(len(batch), width) for c in ("low", "high"))
    wanted = np.zeros((len(batch), books.shape[1]), bool)
    for p in np.unique(part):
        wanted[part == p] = shortlist(low[part == p], high[part == p], books[p])
    for i in range(len(batch)):
        yield i, int(part[i]), np.flatnonzero(wanted[i])


def entry_sums(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """(parts, entries, width + 1): sums of the pieces that each entry takes, and their number."""
    parts, entries, width = books.shape
    out = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("total", T.LongType())])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            rows, raw = batch.column("rows").value_lengths().to_numpy(), batch.column("pieces")
            sums = batch.column("sums").flatten().to_numpy().reshape(len(batch), width)
            for i, part, listed in _blocks(batch, books):
                if len(listed) == 1:
                    totals[part, listed[0], :width] += sums[i]
                    totals[part, listed[0], width] += rows[i]
                    continue
                pieces = np.frombuffer(raw[i].as_buffer(), "<i4").reshape(rows[i], width).astype(np.int64)
                best, _ = nearest(pieces, books[part, listed])
                for k in np.unique(best):
                    totals[part, listed[k], :width] += pieces[best == k].sum(0)
                    totals[part, listed[k], width] += np.count_nonzero(best == k)
        flat = totals.ravel()
        cells = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(flat[cells])], names=out.names)

    columns = ("part", "rows", "low", "high", "sums", "pieces")
    found = blocks.select(*columns).mapInArrow(take, out).groupBy("cell").agg(F.sum("total").alias("total"))
    flat = np.zeros(parts * entries * (width + 1), np.int64)
    for cell, total in found.collect():  # as many rows as the codebooks have numbers
        flat[cell] = total
    return flat.reshape(parts, entries, width + 1)


def codes(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(row, part, entry, error): the entry of every piece and its squared distance."""
    out = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("entry", T.IntegerType()), T.StructField("error", T.LongType()),
    ])
    width = books.shape[2]

    def told(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)) for column in zip(*parts)], names=out.names)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, rows, parts = batch.column("pieces"), batch.column("rows"), []
            for i, part, listed in _blocks(batch, books):
                row = rows[i].values.to_numpy()
                pieces = np.frombuffer(raw[i].as_buffer(), "<i4").reshape(len(row), width).astype(np.int64)
                best, error = nearest(pieces, books[part, listed])
                parts.append((row, np.full(len(row), part, np.int32), listed[best].astype(np.int32), error))
                if len(parts) * BLOCK >= CODED_PIECES:
                    yield told(parts)
                    parts = []
            if parts:
                yield told(parts)

    return blocks.select("part", "rows", "low", "high", "pieces").mapInArrow(assign, out)


def first_books(whole: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "whole").select("whole").limit(entries).collect()
    books = np.zeros((parts, len(first), width), np.int64)
    for k, (vector,) in enumerate(first):
        flat = np.zeros(parts * width, np.int64)
        flat[: len(vector)] = vector
        books[:, k] = flat.reshape(parts, width)
    return books


def fit(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        sums = entry_sums(blocks, books)
        taken = sums[:, :, -1:]
        books = np.where(taken > 0, sums[:, :, :-1] // np.maximum(taken, 1), books)
    return books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) per usable row of `vectors`."""
    whole = checkpointed(whole_vectors(vectors).withColumn("row", F.monotonically_increasing_id()))
    longest = whole.agg(F.max(F.size("whole"))).first()[0] or 0
    width = -(-longest // parts)
    blocks = checkpointed(cut_blocks(whole.select("row", "whole"), width, parts))
    books = fit(blocks, first_books(whole, width, parts, entries), rounds)
    told = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = codes(blocks, books).groupBy("row").agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("part", "entry"))), lambda c: F.lpad(F.lower(F.hex(c["entry"])), 2, "0")
        ), "").alias("code"),
        F.sum("error").alias("error"),
    )
    found = checkpointed(whole.select("row", "vec_id", "label").join(coded, "row"))
    by_label = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return found.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(told).alias("codebooks_sha256")
    )
