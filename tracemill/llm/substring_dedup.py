"""Substring dedup: remove passages that a document shares with an earlier one.

A window is `window` consecutive words of one text. Each word covered by a window whose word
sequence also starts in a document with a smaller id is removed; windows are judged on the
input, not on what is left.

1. *Count-min prefilter.* Every window is counted under its anchor, the smallest hash of the
   `anchor` word sequences inside it. Equal windows have equal anchors, so the anchor's count
   of documents is never below the window's. Neighbouring windows mostly share an anchor:
   one update stands for a whole run of them. Each task adds its updates to a sketch of fixed
   size and emits the cells it touched; the partition sketches are merged by adding equal
   cells. Cells estimated at two or more become a bitmap of fixed size, which is broadcast.
2. *Exact grouping.* A second pass emits only runs whose anchor is estimated repeated. The
   sketch overestimates, so no repeated window is lost; a full sketch only lets more runs
   through. Runs are grouped by anchor and by the hash of all their words: in a document
   with a larger id than the run's smallest, every window of the run is a repeat. Where an
   anchor has several different runs, the windows of each run's first document are grouped
   one by one. Hot passages shrink in the partial aggregation before they are shuffled.
3. Covered word ranges, one row per document, are joined back to the texts. Another bitmap of
   fixed size tells which documents may have any, so that only their texts are shuffled.

Sequences count as equal when anchor and sequence hash (64 bits each) both are.

Defined results: a null or empty text has no words and stays as it is; a text shorter than a
window keeps all words; equal ids are not smaller than each other, so repeated rows of one id
do not remove each other's words; a null id is neither smaller nor larger than any other, its
row is kept whole and removes nothing. Other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.llm.common import KEY_BITS, bitmap, by_bitmap, checkpointed, fresh, giving_back, in_bitmap, text_batches
from tracemill.llm.hashing import Words, mix, running_min, signed

WINDOW = 50
#: Words of an anchor; windows share one more often if it is short.
ANCHOR = 16
#: Cells of a sketch row and rows of the sketch: 2 * 2**26 bits make 16 MB once merged.
SKETCH_BITS = 26
SKETCH_SALTS = (0x9E3779B97F4A7C15, 0x3C6EF372FE94F82A)
SKETCH_ROWS = len(SKETCH_SALTS)
#: Cells that a task gathers before it emits a partial sketch.
FLUSH_CELLS = 1 << 21


def sketch_cells(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each anchor in each row of the sketch."""
    return [
        (mix(anchors ^ np.uint64(salt)) >> np.uint64(64 - bits)).astype(np.int64) + (row << bits)
        for row, salt in enumerate(SKETCH_SALTS)
    ]


class Runs:
    """Runs of windows of one text with the same anchor: `count` windows from word `start`."""

    def __init__(self, words: Words, window: int, anchor: int) -> None:
        least = running_min(words.sequences(anchor), window - anchor + 1)
        inside = words.within(window)
        least = least[: len(inside)]
        new = inside.copy()
        new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
        text = words.text_of()[: len(inside)]
        new[1:] |= inside[1:] & (text[1:] != text[:-1])
        self.start = np.flatnonzero(new)
        # A run ends before the next window that opens one or lies in no text.
        stops = np.flatnonzero(new | ~inside)
        after = np.searchsorted(stops, self.start, side="right")
        self.stop = np.append(stops, len(inside))[after]
        self.count = self.stop - self.start
        self.anchor = least[self.start]
        self.text = text[self.start]


def _params(window: int, anchor: int) -> tuple[int, int]:
    if window < 1:
        raise ValueError("a window has one word at least")
    return window, min(anchor, window)


def repeated_cells(docs: DataFrame, text: str, window: int, anchor: int, bits: int) -> bytes:
    """Bitmap of the sketch cells that two or more documents are estimated to share."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def emit() -> pa.RecordBatch:
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(cells.astype(np.int32)), pa.array(np.minimum(n, 2).astype(np.int32))], names=["cell", "n"]
            )

        for batch in batches:
            for _, texts in text_batches(batch, text):
                runs = Runs(Words(texts), window, anchor)
                order = np.lexsort((runs.anchor, runs.text))
                owner, value = runs.text[order], runs.anchor[order]
                once = np.ones(len(order), bool)  # an anchor counts once in a document
                once[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
                held.extend(sketch_cells(value[once], bits))
                size += SKETCH_ROWS * int(once.sum())
                if size >= FLUSH_CELLS:
                    yield emit()
                    held, size = [], 0
        if size:
            yield emit()

    cells = docs.select(text).mapInArrow(giving_back(sketch), "cell int, n int").groupBy("cell").agg(F.sum("n").alias("n"))
    return bitmap(cells.where("n >= 2"), SKETCH_ROWS << bits)


def _candidates(docs: DataFrame, window: int, anchor: int, bits: int) -> DataFrame:
    """Runs of the rows of `docs` (doc, text, version) whose anchor may be repeated."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated_cells(docs, "text", window, anchor, bits))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_batches(batch, "text"):
                words = Words(texts)
                runs = Runs(words, window, anchor)
                keep = np.ones(len(runs.start), bool)
                for cells in sketch_cells(runs.anchor, bits):
                    keep &= in_bitmap(shared.value, cells)
                start, count, owner = runs.start[keep], runs.count[keep], runs.text[keep]
                if not len(start):
                    continue
                offsets = np.concatenate([[0], np.cumsum(count)])
                at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - start, count)
                windows = words.spans(at, at + window)
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc").take(rows), part.column("version").take(rows),
                    pa.array(signed(runs.anchor[keep])),
                    pa.array(signed(words.spans(start, start + count + window - 1))),
                    pa.array((start - words.first[owner]).astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(signed(windows))),
                ], names=["doc", "version", "anchor", "run", "start", "count", "windows"])

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.where("doc is not null").mapInArrow(
        giving_back(find), f"doc {kind}, version long, anchor long, run long, start int, count int, windows array<long>"
    )


def covered_ranges(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bits: int = SKETCH_BITS) -> DataFrame:
    """(doc, version, ranges): word ranges [start, end) of `docs` (doc, text, version) to remove."""
    window, anchor = _params(window, anchor)
    found = checkpointed(_candidates(docs, window, anchor, bits))
    runs = found.groupBy("anchor", "run").agg(F.min("doc").alias("least"))
    several = runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    firsts = runs.join(several.withColumn("several", F.lit(True)), "anchor", "left")
    placed = found.join(firsts, ["anchor", "run"])
    later = placed.where("doc > least").select(
        "doc", "version", "start", (F.col("start") + F.col("count") + (window - 1)).alias("end")
    )
    edge = placed.where("doc = least and several").select(
        "doc", "version", "anchor", "start", F.posexplode("windows").alias("at", "words")
    )
    earliest = edge.groupBy("anchor", "words").agg(F.min("doc").alias("least"))
    within = edge.join(earliest, ["anchor", "words"]).where("doc > least").select(
        "doc", "version", (F.col("start") + F.col("at")).alias("start"), (F.col("start") + F.col("at") + window).alias("end")
    )
    # Repeated rows of a document have the same ranges: each is held once.
    return later.union(within).groupBy("doc", "version").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
                   anchor: int = ANCHOR, bits: int = SKETCH_BITS, layout: bool = False,
                   names: tuple[str, str] = ("n_words", "n_removed")) -> DataFrame:
    """`docs` with repeated passages cut from `text`, and the counts of words and removed words.

    Kept words are joined by one space. With `layout` the white space of the text stays: what
    is cut is each removed word and the white space after it, and untouched texts stay as they are.
    """
    version, ranges, key, cell = fresh(docs, "version", "ranges", "doc", "cell")
    keyed = docs.withColumn(version, F.xxhash64(F.col(text)))
    found = checkpointed(covered_ranges(
        keyed.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"), F.col(version).alias("version")), window, anchor, bits
    ))
    found = found.select(F.col("doc").alias(key), F.col("version").alias(f"{version}_"), F.col("ranges").alias(ranges))
    slot = lambda *columns: F.pmod(F.xxhash64(*columns), F.lit(1 << KEY_BITS))
    touched = docs.sparkSession.sparkContext.broadcast(
        bitmap(found.select(slot(key, f"{version}_").alias("cell")), 1 << KEY_BITS)
    )
    total, removed = names
    fields = [f for f in docs.schema.fields if f.name not in names]
    placed = keyed.select(*(f.name for f in fields), version, slot(doc_id, version).alias(cell))

    some = by_bitmap(placed, cell, touched, True)
    joined = some.join(found, (some[doc_id] == found[key]) & (some[version] == found[f"{version}_"]), "left")
    joined = joined.select(*(some[f.name] for f in fields), found[ranges])
    place = [f.name for f in fields].index(text)
    schema = T.StructType([*fields, T.StructField(total, T.LongType()), T.StructField(removed, T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_batches(batch, text):
                yield cut_part(part, texts, part.column(len(fields)))

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here = in_bitmap(touched.value, batch.column(cell).to_numpy(zero_copy_only=False))
            for part, texts in text_batches(batch.filter(pa.array(~here)), text):
                yield cut_part(part, texts, None)

    def cut_part(part: pa.RecordBatch, texts: list[bytes], lists: pa.ListArray | None) -> pa.RecordBatch:
        kept: list[bytes] = []
        counts: list[tuple[int, int]] = []
        if lists is not None:
            bounds, present = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
            starts, ends = (lists.values.field(k).to_numpy() for k in (0, 1))
        for i, raw in enumerate(texts):
            words = raw.split()
            gone = 0
            if lists is not None and present[i]:
                mine = slice(bounds[i], bounds[i + 1])
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, starts[mine], 1)
                np.add.at(edges, ends[mine], -1)
                covered = np.cumsum(edges)[:-1] > 0
                gone = int(covered.sum())
            counts.append((len(words), gone))
            if not gone:
                kept.append(raw if layout else b" ".join(words))
            elif not layout:
                kept.append(b" ".join(w for w, c in zip(words, covered, strict=True) if not c))
            else:
                kept.append(_without(raw, Words([raw]).start, covered))
        columns = list(part.columns[: len(fields)])
        columns[place] = pc.if_else(columns[place].is_valid(), pa.array(kept, pa.binary()).cast(pa.string()), None)
        columns += [pa.array([c[k] for c in counts], pa.int64()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    others = placed.select(*(f.name for f in fields), cell)
    return joined.mapInArrow(giving_back(cut), schema).union(others.mapInArrow(giving_back(leave), schema))


def _without(raw: bytes, start: np.ndarray, covered: np.ndarray) -> bytes:
    """`raw` without the covered words, each with the white space up to the next word."""
    bounds = np.append(start, len(raw))
    flips = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    out, at = [], 0
    for first, last in zip(flips[::2], flips[1::2], strict=True):
        out.append(raw[at : bounds[first]])
        at = bounds[last]
    return b"".join([*out, raw[at:]])
