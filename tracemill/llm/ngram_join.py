"""N-gram Jaccard join: MinHash banding, verified on full n-gram sets.

1. Documents with the same n-gram set form one class; only classes go on, so that exact
   copies, however many, cost one row. A class key is a 128-bit sum over its n-grams.
2. Band and row counts follow from the target recall: the most rows a band can have while the
   bands needed to find a pair at the threshold with that recall stay within the hash budget.
3. Classes are grouped on band hashes. Every member of a bucket is paired with its pivot, the
   member that meets most others over all bands, and the pair is verified on the two full
   n-gram sets. Members that verified links connect need no further look. The members of buckets that
   still hold several groups are then compared with each other, block by block, so that no
   colliding pair stays undecided unless both are in one group already. Pairs are candidates
   for as long as they are being counted in a task; only links leave it. A bucket of n near
   copies that the pivot links costs n pairs; one that stays open costs its square in counting.
4. Verified links are contracted to groups by star contraction on executors.
5. Links are counted among all pairs of a group, whichever buckets they share. As every colliding
   pair was decided, no link leads out of its group. Each set is reduced to its difference from
   its group's pivot, from which common n-grams of any two follow exactly, and near copies differ
   little. Jaccard distances obey the triangle inequality: sets that are both near enough to the
   pivot are linked, sets whose distances from it differ too much are not, and both are settled
   by counting. The others are compared block by block. Tasks return one partial count per class
   and never pairs.

A set's n-grams are the `size` consecutive words from each word on (words: white-space
separated, unchanged); a shorter text has all its words as its one n-gram. Two sets are linked
if their Jaccard similarity is at least `threshold`.

Defined results: a null or empty text and a text without words has no n-grams, links to
nothing and is a group of its own; rows of one id and text are one row; a null id cannot be
named and its row has no group. Other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.common import KEY_BITS, Tables, bitmap, by_bitmap, giving_back, small_batches, smallest_reachable, text_batches
from tracemill.llm.hashing import Words, mix, signed

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.999
#: Members of a bucket that a task compares with as many others.
BLOCK = 256
#: Members of a group, and bytes of their differences, that a task compares with as many others.
GROUP_BLOCK, GROUP_BYTES = 1024, 8 << 20
#: Bands of distance from the pivot, over the distance that links may have.
RINGS = 8
#: Distances this close to a bound are compared and not taken as settled.
CLOSE = 1e-9
#: N-grams that are compared at once, as columns of a matrix.
COLUMNS = 4096
#: Hashes of a signature. Many rows in a band keep texts that share only a common passage apart.
MAX_HASHES = 640


def choose_bands(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): pairs at `threshold` share a band with probability `recall` or more.

    Fails where no banding within `max_hashes` reaches that recall.
    """
    best = None
    for rows in range(1, max_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError(f"{max_hashes} hashes do not reach a recall of {recall} at a similarity of {threshold}; allow more")
    return best


class Grams:
    """Distinct n-gram hashes of a list of texts: `hash[first[d]:first[d + 1]]` of text d, sorted."""

    def __init__(self, texts: list[bytes], size: int) -> None:
        words = Words(texts)
        gram, inside, text = words.sequences(size), words.within(size), words.text_of()
        value, owner = gram[inside], text[: len(gram)][inside]
        short = np.flatnonzero((words.count > 0) & (words.count < size))
        if len(short):
            value = np.concatenate([value, words.spans(words.first[short], words.first[short + 1])])
            owner = np.concatenate([owner, short])
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        once = np.ones(len(value), bool)
        once[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        self.hash = value[once]
        self.first = np.searchsorted(owner[once], np.arange(len(texts) + 1))
        self.filled = np.flatnonzero(np.diff(self.first) > 0)

    def keys(self) -> np.ndarray:
        """16 bytes for each text with n-grams, equal for equal sets."""
        starts = self.first[self.filled]
        out = np.empty((len(starts), 2), np.uint64)
        size = np.diff(self.first)[self.filled].astype(np.uint64)
        for k, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
            if len(starts):
                out[:, k] = mix(np.add.reduceat(mix(self.hash ^ np.uint64(salt)), starts) ^ size)
        return out

    def bands(self, bands: int, rows: int) -> np.ndarray:
        """Hash of each band's `rows` minima, for each text with n-grams."""
        starts = self.first[self.filled]
        out = np.zeros((len(starts), bands), np.uint64)
        if not len(starts):
            return out
        low = (self.hash >> np.uint64(32)).astype(np.uint32)
        state = np.random.default_rng(1).integers(0, 1 << 32, (bands * rows, 2), dtype=np.uint32)
        for band in range(bands):
            value = np.full(len(starts), band, np.uint64)
            for row in range(band * rows, (band + 1) * rows):
                flip, factor = state[row]
                least = np.minimum.reduceat((low ^ flip) * (factor | np.uint32(1)), starts)
                value = mix(value * np.uint64(0x100000001B3) + least)
            out[:, band] = value
        return out


def _binary(keys: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(np.ascontiguousarray(keys))]).cast(pa.binary())


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc, class, bands) of `docs` (doc, text); class is null without n-grams."""
    kind = docs.schema["doc"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_batches(batch, "text"):
                grams = Grams(texts, size)
                values = grams.bands(bands, rows)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc").take(pa.array(grams.filled)), _binary(grams.keys()),
                    pa.ListArray.from_arrays(pa.array((np.arange(len(values) + 1) * bands).astype(np.int32)), pa.array(signed(values.ravel()))),
                ], names=["doc", "class", "bands"])

    return docs.where("doc is not null").mapInArrow(giving_back(sign), f"doc {kind}, class binary, bands array<long>")


def gram_sets(docs: DataFrame, size: int) -> DataFrame:
    """(class, grams): the sorted n-gram hashes, 8 bytes each, of each text in `docs` (text)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_batches(batch, "text"):
                grams = Grams(texts, size)
                raw = grams.hash.tobytes()
                first = grams.first * 8
                sets = [raw[first[d] : first[d + 1]] for d in grams.filled]
                yield pa.RecordBatch.from_arrays([_binary(grams.keys()), pa.array(sets, pa.binary())], names=["class", "grams"])

    return docs.select("text").mapInArrow(giving_back(gather), "class binary, grams binary")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The `pairs` (a, b) whose sets are similar enough, with their similarity."""
    left = sets.select(F.col("class").alias("a"), F.col("grams").alias("left"))
    right = sets.select(F.col("class").alias("b"), F.col("grams").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                    score.append(0.0)
                    continue
                merged = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((merged[1:] == merged[:-1]).sum())
                score.append(common / (len(x) + len(y) - common))
            keep = np.flatnonzero(np.array(score) >= threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), pa.array(np.array(score)[keep])],
                names=["a", "b", "similarity"],
            )

    return both.mapInArrow(giving_back(judge), "a binary, b binary, similarity double")


def shared_counts(sets: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each of the sets, how many of its elements every set holds."""
    sizes = [len(x) for x in sets]
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(sizes)])
    for k in range(len(sets)):
        here = np.zeros(number.max() + 1, np.int64)
        here[number[first[k] : first[k + 1]]] = 1
        yield np.add.reduceat(here[number], first[:-1])


def linked_in_buckets(members: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Links (a, b, similarity) between `members` (value, class, label, grams) of one bucket and
    different labels.

    A bucket's members are dealt into blocks of about `block`; each pair of blocks is a task of
    its own that counts common n-grams and returns the links, so that neither the bucket nor its
    pairs are ever in one place.
    """
    blocks = members.groupBy("value").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = members.join(blocks, "value").withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "class", "label", "grams")

    def judge(table: pa.Table) -> pa.Table:
        classes, labels, own = (table[name].to_pylist() for name in ("class", "label", "own"))
        sets = [np.frombuffer(value.as_buffer(), np.uint64) for value in table["grams"]]
        sizes = np.array([len(x) for x in sets])
        out: list[tuple[bytes, bytes, float]] = []
        within = table["low"][0] == table["high"][0]
        for k, common in enumerate(shared_counts(sets)):
            score = common / (sizes + sizes[k] - common)
            for j in np.flatnonzero(score >= threshold):
                if classes[k] < classes[j] and labels[k] != labels[j] and (within or own[k] != own[j]):
                    out.append((classes[k], classes[j], float(score[j])))
        a, b, similarity = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "similarity": pa.array(similarity, pa.float64())})

    found = dealt.groupBy("value", "low", "high").applyInArrow(judge, "a binary, b binary, similarity double")
    return found.dropDuplicates(["a", "b"])


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of `left` has in common with each of `right`."""
    sizes = [len(x) for x in left], [len(x) for x in right]
    values, number = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    sides = number[: sum(sizes[0])], number[sum(sizes[0]) :]
    both = np.logical_and(*(np.bincount(side, minlength=len(values)) > 0 for side in sides))
    column = np.cumsum(both) - 1
    places = []
    for side, size in zip(sides, sizes, strict=True):
        row, at = np.repeat(np.arange(len(size)), size)[both[side]], column[side[both[side]]]
        order = np.argsort(at, kind="stable")
        places.append((row[order], at[order]))
    out = np.zeros((len(left), len(right)))
    for low in range(0, int(both.sum()), COLUMNS):
        parts = []
        for (row, at), size in zip(places, sizes, strict=True):
            first, last = np.searchsorted(at, [low, low + COLUMNS])
            part = np.zeros((len(size), COLUMNS), np.float32)
            part[row[first:last], at[first:last] - low] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def differences(both: DataFrame) -> DataFrame:
    """Of `both` (class, label, parts, grams, base): (class, label, parts, base, missing, diff, distance): the
    size of the set `base`, how many of its n-grams `grams` lacks, the n-grams that only one of
    the two has, and their Jaccard distance."""

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, bytes, float]] = []
            for own, other in zip(batch.column(3), batch.column(4), strict=True):
                x, base = (np.frombuffer(v.as_buffer(), np.uint64) for v in (own, other))
                diff = np.setxor1d(x, base, assume_unique=True)
                common = (len(x) + len(base) - len(diff)) // 2
                out.append((len(base), len(base) - common, diff.tobytes(), len(diff) / (common + len(diff))))
            size, missing, diff, distance = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(size, pa.int64()), pa.array(missing, pa.int64()),
                 pa.array(diff, pa.binary()), pa.array(distance, pa.float64())],
                names=["class", "label", "parts", "base", "missing", "diff", "distance"],
            )

    return both.select("class", "label", "parts", "grams", "base").mapInArrow(
        giving_back(differ), "class binary, label binary, parts int, base long, missing long, diff binary, distance double"
    )


def link_counts(labels: DataFrame, sets: DataFrame, threshold: float, block: int = GROUP_BLOCK, block_bytes: int = GROUP_BYTES) -> DataFrame:
    """(class, n_links): links of each class in `labels` (node, label, met) to others of its label.

    A label's pivot is the class that met most others. Classes of a label with more than a
    block of them are dealt into rings by their distance from it, large rings into blocks; each pair of blocks whose links do not follow from
    the distances is a task of its own that returns how many links each class has there.
    """
    tables = Tables(labels.sparkSession)
    named = labels.select(F.col("node").alias("class"), "label", "met")
    groups = named.groupBy("label").agg(F.count("*").alias("n"), F.max_by("class", F.struct("met", "class")).alias("pivot"))
    named = tables.keep(named.join(groups, "label").select("class", "label", "n", "pivot", F.ceil(F.col("n") / block).cast("int").alias("parts")))
    # A group of two is one link.
    pairs = named.where("n = 2").select("class", F.lit(1).cast("long").alias("n_links"))
    larger = named.where("n > 2")
    # A pivot's set goes to every part of its group once.
    pivots = larger.where(F.col("class") == F.col("pivot")).join(sets.withColumnRenamed("grams", "base"), "class")
    pivots = pivots.select("label", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "base")
    own = larger.join(sets, "class").withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    reduced = tables.keep(differences(own.join(pivots, ["label", "part"])))
    reach = 1 - threshold
    members = reduced.withColumn("ring", F.when(F.col("parts") > 1, F.floor(F.col("distance") * (RINGS / max(reach, CLOSE)))).otherwise(0).cast("int"))
    rings = members.groupBy("label", "ring").agg(
        F.count("*").alias("n"), F.sum(F.length("diff")).alias("bytes"), F.min("distance").alias("low"), F.max("distance").alias("high")
    )
    blocks = F.ceil(F.greatest(F.col("n") / block, F.least(F.col("bytes") / block_bytes, "n"))).cast("int")
    # A label has RINGS / reach rings at most.
    rings = rings.groupBy("label").agg(F.collect_list(F.struct("ring", "n", "low", "high", blocks.alias("blocks"))).alias("rings"))
    rings = rings.select("label", "rings", F.explode("rings").alias("mine"))
    linked = lambda r: r["high"] + F.col("mine.high") <= reach - CLOSE
    apart = lambda r: F.greatest(r["low"] - F.col("mine.high"), F.col("mine.low") - r["high"]) > reach + CLOSE
    settled = F.aggregate(F.filter("rings", linked), F.lit(0).cast("long"), lambda n, r: n + r["n"] - (r["ring"] == F.col("mine.ring")).cast("long"))
    block_id = lambda ring, number: F.shiftleft(ring.cast("long"), 40) + number
    others = F.flatten(F.transform(
        F.filter("rings", lambda r: ~linked(r) & ~apart(r)),
        lambda r: F.transform(F.sequence(F.lit(0), r["blocks"] - 1), lambda k: block_id(r["ring"], k)),
    ))
    rings = rings.select("label", F.col("mine.ring").alias("ring"), F.col("mine.blocks").alias("blocks"), settled.alias("settled"), others.alias("others"))
    dealt = members.join(rings, ["label", "ring"])
    known = dealt.select("class", F.col("settled").alias("n_links"))
    dealt = dealt.withColumn("own", block_id(F.col("ring"), F.pmod(F.xxhash64("class"), F.col("blocks")))).withColumn("other", F.explode("others"))
    dealt = dealt.select("label", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "class", "base", "missing", "diff")

    def count(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(value.as_buffer(), np.uint64) for value in table["diff"]]
        missing, base = table["missing"].to_numpy(), table["base"].to_numpy()
        size = base - 2 * missing + np.array([len(x) for x in sets])
        own, low, high = table["own"].to_numpy(), table["low"][0].as_py(), table["high"][0].as_py()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        number = np.zeros(len(sets), np.int64)
        if len(left) and len(right):
            common = common_counts([sets[k] for k in left], [sets[k] for k in right])
            common += (base - missing)[left][:, None] - missing[right]
            linked = common / (size[left][:, None] + size[right] - common) >= threshold
            if low == high:
                np.fill_diagonal(linked, False)
            else:
                number[right] = linked.sum(0)
            number[left] = linked.sum(1)
        found = np.flatnonzero(number)
        return pa.table({"class": table["class"].take(pa.array(found)), "n_links": pa.array(number[found])})

    parts = dealt.groupBy("label", "low", "high").applyInArrow(count, "class binary, n_links long")
    return pairs.union(known.union(parts).groupBy("class").agg(F.sum("n_links").alias("n_links")))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def class_links(docs: DataFrame, size: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL,
                max_hashes: int = MAX_HASHES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of `docs` (doc, text): (doc, class) members, (node, label, met) group label and verified
    links of each linked class, (class, grams) sets of all classes that share a bucket."""
    bands, rows = choose_bands(threshold, recall, max_hashes)
    tables = Tables(docs.sparkSession)
    signed_docs = tables.keep(signatures(docs, size, bands, rows))
    members = signed_docs.select("doc", "class").distinct()
    classes = signed_docs.groupBy("class").agg(F.min("doc").alias("doc"), F.first("bands").alias("bands"))
    # A band's hash holds its number. Short keys travel with the hashes; classes that share
    # one, should that ever happen, are candidates of each other like any in one bucket.
    buckets = classes.select(F.xxhash64("class").alias("short"), F.explode("bands").alias("value"))
    shared = buckets.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    found = tables.keep(buckets.join(shared, "value"))
    # The pivot is the member that meets most others in all its buckets: the text that others
    # are copies of is nearer to them than they are to each other.
    central = found.groupBy("short").agg(F.sum(F.col("n") - 1).alias("met"))
    held = found.join(central, "short").select("value", "short", "met")
    pivots = held.groupBy("value").agg(F.max_by("short", F.struct("met", "short")).alias("pivot"))
    named = classes.select("class", F.xxhash64("class").alias("short")).join(central.select("short"), "short", "left_semi")
    named = tables.keep(named)
    pivot_names = named.select(F.col("class").alias("pivot_class"), F.col("short").alias("pivot"))
    placed = held.join(pivots, "value").join(named, "short").join(pivot_names, "pivot")
    placed = tables.keep(placed.select("value", "class", "pivot_class"))
    tables.drop(found, named)
    # The sets of colliding classes: text is read again rather than kept for all classes.
    needed = placed.select("class").distinct()
    sources = tables.keep(classes.select("class", "doc").join(needed, "class", "left_semi").select("doc").distinct())
    slot = F.pmod(F.xxhash64("doc"), F.lit(1 << KEY_BITS)).alias("cell")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(sources.select(slot), 1 << KEY_BITS))
    near = by_bitmap(docs.select("doc", "text", slot), "cell", wanted, True)
    texts = near.join(sources, "doc", "left_semi").select("text")
    sets = tables.keep(gram_sets(texts, size).join(needed, "class", "left_semi").dropDuplicates(["class"]))
    tables.drop(sources)
    wanted.destroy()
    tried = _ordered(placed.select(F.col("class").alias("x"), F.col("pivot_class").alias("y")))
    links = tables.keep(verified(tried, sets, threshold))
    labels = tables.keep(smallest_reachable(links))
    # Buckets that still hold several groups: their members are compared with each other.
    grouped = placed.select("value", "class").join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "label", F.coalesce("label", "class")
    )
    split = grouped.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    rest = grouped.join(split.select("value"), "value", "left_semi").join(sets, "class")
    more = tables.keep(linked_in_buckets(rest.select("value", "class", "label", "grams"), threshold))
    tables.drop(placed)
    ends = links.union(more)
    ends = ends.select(F.col("a").alias("node")).union(ends.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("met"))
    labels = ends.join(_merged(labels, more), "node")
    return members, labels, sets


def _merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """`labels` (node, label) after further links (a, b): only the labels are contracted."""
    if more.isEmpty():
        return labels
    label = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
    joined = more.join(label("a"), "a", "left").join(label("b"), "b", "left")
    joined = joined.select("a", "b", *(F.coalesce(f"label_{end}", end).alias(f"label_{end}") for end in "ab"))
    tops = smallest_reachable(joined.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    nodes = labels.union(joined.select("a", "label_a")).union(joined.select("b", "label_b")).distinct()
    found = nodes.join(tops.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left")
    return found.select("node", F.coalesce("top", "label").alias("label"))


def similar_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = NGRAM,
                      threshold: float = THRESHOLD, recall: float = RECALL, count_links: bool = True) -> DataFrame:
    """One row per document: `doc_id`, class_id, group_id, n_copies, n_links.

    class_id and group_id are the smallest ids of the documents with the same n-gram set, and
    of those that links connect. n_copies counts the other documents of the class. n_links
    counts the other classes linked to this one. Without `count_links` there is no column
    n_links, for callers that need groups only.
    """
    small_batches(docs.sparkSession)
    plain = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    members, labels, sets = class_links(plain, size, threshold, recall)
    tables = Tables(docs.sparkSession)
    labels = tables.keep(labels)
    classes = members.groupBy("class").agg(F.min("doc").alias("class_id"), (F.count("*") - 1).alias("n_copies"))
    classes = classes.join(labels.select(F.col("node").alias("class"), "label"), "class", "left")
    counts = ["n_copies"]
    if count_links:
        classes = classes.join(link_counts(labels, sets, threshold), "class", "left")
        counts.append("n_links")
    classes = tables.keep(classes.withColumn("label", F.coalesce("label", "class")))
    groups = classes.groupBy("label").agg(F.min("class_id").alias("group_id"))
    classes = classes.join(groups, "label").select("class", "class_id", "group_id", *counts)
    found = members.join(classes, "class").groupBy("doc").agg(
        F.min("class_id").alias("class_id"), F.min("group_id").alias("group_id"), *(F.max(name).alias(name) for name in counts)
    )
    ids = plain.select("doc").distinct()
    return ids.join(found, "doc", "left").select(
        F.col("doc").alias(doc_id), F.coalesce("class_id", "doc").alias("class_id"), F.coalesce("group_id", "doc").alias("group_id"),
        *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts),
    )
