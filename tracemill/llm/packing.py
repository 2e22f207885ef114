"""Packing: shortest-pack-first over the histogram of piece lengths.

1. Each whole text is encoded, closed with one end id and cut into pieces of at most the
   sequence length. Pieces are checkpointed.
2. Counts per length, at most as many rows as a sequence has tokens, reach the driver.
   Lengths are placed longest first, each into the pack with the most room left; packs of
   the same make-up are one pattern with a count, so the work does not follow the data.
3. Every piece gets its rank among the pieces of its length. Ranks are counted within the
   checkpoint's partitions and shifted by the counts of the partitions before, so that a
   length which a third of all pieces share is many small groups. A pattern's slot owns an
   interval of ranks of its length, which gives the piece its sequence and place.

Each id lies in exactly one piece and each piece in one sequence. Defined results: a null or
empty text is one piece with the end id alone; repeated rows are packed as often as they
occur; an empty table gives no rows. Other columns ride along if named in `keep`.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.llm.common import checkpointed, giving_back, small_batches
from tracemill.llm.tokens import TokenEncoder, default_path

SEQUENCE = 1024
END_ID = 0


def encoded_pieces(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = SEQUENCE,
                   tokenizer: str | None = None, end_id: int = END_ID, ids: bool = True, added: bool = False) -> DataFrame:
    """One row per piece: `keep`, start, length, ids_crc32, doc_tokens and, if asked, ids. With
    `added`, added tokens in a text are what the library makes of them, not ordinary text."""
    path = tokenizer or default_path()
    schema = T.StructType([docs.schema[name] for name in keep])
    for name in ("start", "length", "ids_crc32", "doc_tokens"):
        schema = schema.add(name, T.LongType())
    if ids:
        schema = schema.add("ids", T.ArrayType(T.LongType()))
    tail = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenEncoder.load(path, added)
        for batch in batches:
            row, start, length, crc, total, values = [], [], [], [], [], []
            for i, value in enumerate(batch.column(0).to_pylist()):
                raw = encoder.encode(value or "") + tail
                for at in range(0, len(raw), 4 * size):
                    part = raw[at : at + 4 * size]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(len(raw) // 4)
                    if ids:
                        values.append(np.frombuffer(part, "<u4").astype(np.int64))
            taken = batch.take(pa.array(row, pa.int64()))
            columns = [*taken.columns[1:], *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            if ids:
                columns.append(pa.array(values, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(text).alias("text"), *keep).mapInArrow(giving_back(cut), schema)


@dataclass
class Pattern:
    lengths: tuple[int, ...]
    count: int


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[Pattern]:
    """Patterns of packs for `histogram` (length: count): longest lengths first, each into
    the pack with the most room left, or into a new one if it does not fit there."""
    open_packs: dict[int, list[Pattern]] = defaultdict(list)  # by room left
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        grown = []
        while left:
            room = max(open_packs, default=0)
            if room < length:
                grown.append((size - length, Pattern((length,), left)))
                break
            pattern = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
            used = min(left, pattern.count)
            if used < pattern.count:
                open_packs[room].append(Pattern(pattern.lengths, pattern.count - used))
            into = (room - length, Pattern((*pattern.lengths, length), used))
            # A grown pack may take the same length again; the others of this length come first.
            if into[0] >= length:
                open_packs[into[0]].append(into[1])
            else:
                grown.append(into)
            left -= used
        for room, pattern in grown:
            open_packs[room].append(pattern)
    return [p for room in sorted(open_packs) for p in open_packs[room]]


def slots(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, first sequence and place in it, of each interval of ranks."""
    next_rank: dict[int, int] = defaultdict(int)
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern in patterns:
        at = 0
        for length in pattern.lengths:
            out[length].append((next_rank[length], sequence, at))
            next_rank[length] += pattern.count
            at += length
        sequence += pattern.count
    return {length: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for length, rows in out.items()}


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """`pieces`, rows with a `length` of 1 to `size`, with `sequence_id` and `offset`."""
    pieces = checkpointed(pieces)
    placed = pieces.withColumn("part_", F.spark_partition_id())
    counts = checkpointed(placed.groupBy("length", "part_").agg(F.count("*").alias("n_")))
    total = counts.groupBy("length").agg(F.sum("n_").alias("n")).collect()  # at most `size` rows
    before = Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("base_"))
    own = Window.partitionBy("length", "part_").orderBy(*(c for c in pieces.columns if c in ("doc_id", "start", "ids_crc32")) or ["length"])
    ranked = placed.withColumn("rank_", F.row_number().over(own) - 1).join(base, ["length", "part_"])
    ranked = ranked.select(*pieces.columns, (F.col("base_") + F.col("rank_")).cast("long").alias("rank_"))
    owners = pieces.sparkSession.sparkContext.broadcast(slots(shortest_pack_first({r["length"]: r["n"] for r in total}, size)))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    at = pieces.columns.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (at, len(schema) - 2))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                mine = np.flatnonzero(length == value)
                first, start, slot = owners.value[int(value)]
                k = np.searchsorted(first, rank[mine], side="right") - 1
                sequence[mine] = start[k] + rank[mine] - first[k]
                offset[mine] = slot[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(giving_back(place), schema)


def pack_documents(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = SEQUENCE,
                   tokenizer: str | None = None, end_id: int = END_ID, ids: bool = True, added: bool = False) -> DataFrame:
    """Pieces of all `docs` with their sequence and place in it."""
    small_batches(docs.sparkSession)
    return pack(encoded_pieces(docs, text, keep, size, tokenizer, end_id, ids, added), size)
