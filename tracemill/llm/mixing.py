"""Mixing sources to target weights by a low-discrepancy schedule.

A source's documents stand in a shuffled order (by hash), and that stream is read up to three
times; it is cut into blocks of equal token counts. Slot i of the schedule has the i-th van der
Corput point, which the cumulative targets map to a source; the source's r-th slot takes its
r-th block. Any stretch of the schedule therefore holds the sources in nearly their shares. A
source needs as many slots as its target has blocks, rounded up, its last block being cut to the
target. Where the points give a source a few slots more than that, those slots, in order, go to
the sources which the points left short.

Points and boundaries meet in one sorted union, and positions, offsets and ranks are running
totals over ranges (`operators.ranges`), so that a source which holds a third of all rows, or a
table with as many sources as documents, is no special case.

Weights: the sources by code point, null last, weigh 5, 2, 1, repeating. They share all tokens;
a target stops at `most` times its source's size, and the excess is shared again by weight until
no source is above. A token is a word `[^\\x20\\x09-\\x0D]+`.

Defined results: a null text has size 0; documents of size 0, and all documents of an empty
source, are never taken. Null is a source of its own, and so is the empty one. Rows with equal
ids are documents of their own; equal rows are interchangeable. Only `doc_id`, `source` and `text` are read. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.llm.common import checkpointed, text_batches
from tracemill.llm.hashing import SEPARATORS
from tracemill.operators.ranges import running

WEIGHTS = (5, 2, 1)
#: How often a document may be taken.
MOST = 3
BLOCK_TOKENS = 1024
#: Bits of a van der Corput point: more slots than that are not told apart.
POINT_BITS = 52


def kept(df: DataFrame, label: str) -> DataFrame:
    return checkpointed(df)


def word_counts(texts: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = ~SEPARATORS[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    begins = np.concatenate([[0], np.cumsum(inside & ~np.concatenate([[False], inside[:-1]]))])
    return np.diff(begins[np.concatenate([[0], ends])])


def with_sizes(docs: DataFrame) -> DataFrame:
    """`docs` with the column `text` replaced by `size`, its number of words."""
    fields = [f for f in docs.schema.fields if f.name != "text"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_batches(batch, "text"):
                sizes = pa.array(word_counts(texts), pa.int64())
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in fields], sizes], [*[f.name for f in fields], "size"])

    return docs.mapInArrow(count, T.StructType([*fields, T.StructField("size", T.LongType())]))


def van_der_corput(slot: Column) -> Column:
    """The bits of the slot number, last one first, as a number below 2**POINT_BITS."""
    return F.conv(F.rpad(F.reverse(F.bin(slot)), POINT_BITS, "0"), 2, 10).cast("long")


def shuffled(doc_id: Column) -> Column:
    """60 bits of the id's MD5 digest: an order that any other system can reproduce."""
    return F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, start, doc): where each document stands in its source's stream.

    `doc` numbers the documents of a source; all of its words stand from `start` on.
    """
    read = with_sizes(docs.select(
        "doc_id", "source", "text", shuffled(F.col("doc_id")).alias("shuffled"), F.xxhash64("text").alias("told_apart")
    ))
    placed = running(
        read, ["source"], ["shuffled", "doc_id", "size", "told_apart"], kept, {"doc": F.lit(1), "until": F.col("size")}
    )
    return placed.select("doc_id", "source", "size", (F.col("until") - F.col("size")).alias("start"), "doc")


def source_targets(documents: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target) for documents (source, size).

    Only totals over the capped and the free sources reach the driver, once for each round.
    """
    sizes = documents.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running(sizes, [], [F.col("source").asc_nulls_last()], kept, {"rank": F.lit(1)})
    weight = F.element_at(F.lit(list(weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    cap, wide = F.col("source_size") * most, "decimal(38,0)"
    sources = checkpointed(ranked.select("source", "source_size", weight.cast("long").alias("weight"), F.lit(False).alias("capped")))
    before = -1
    while True:
        sums = sources.agg(
            F.sum("source_size").alias("total"), F.sum(F.when(F.col("capped"), cap)).alias("spent"),
            F.sum(F.when(~F.col("capped"), F.col("weight"))).alias("free"), F.count_if("capped").alias("capped"),
        ).first()
        left, free = (sums.total or 0) - (sums.spent or 0), sums.free or 1
        if sums.capped == before:
            break
        before = sums.capped
        # weight * left / free is above the cap, compared as whole numbers.
        above = F.col("weight").cast(wide) * F.lit(left).cast(wide) > cap.cast(wide) * F.lit(free).cast(wide)
        sources = checkpointed(sources.withColumn("capped", F.col("capped") | above))
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(free).cast("double")
    target = F.when(F.col("capped"), cap.cast("double")).otherwise(share)
    return sources.select("source", "source_size", "weight", target.alias("target"))


def with_quotas(targets: DataFrame, block_tokens: int) -> DataFrame:
    """How many tokens and blocks a source gives: the target as a whole number."""
    quota = F.floor(F.col("target") + 0.5)
    return targets.withColumn("quota", quota).withColumn("blocks", F.ceil(F.col("quota") / block_tokens))


def schedule(quotas: DataFrame) -> DataFrame:
    """(slot, source, block): slots from 0 on, each with one block; blocks of a source from 0 on."""
    spark = quotas.sparkSession
    sources = checkpointed(running(
        quotas.where("blocks > 0"), [], [F.col("source").asc_nulls_last()], kept,
        {"number": F.lit(1), "share": F.col("blocks")},
    ))
    slots = sources.agg(F.coalesce(F.sum("blocks"), F.lit(0)).alias("n")).first().n
    span = F.lit(2.0**POINT_BITS)
    # A source's stretch begins where those before it end; points in it are its slots.
    begins = F.floor((F.col("share") - F.col("blocks")) / F.lit(max(slots, 1)) * span).cast("long")
    bounds = sources.select(begins.alias("at"), F.lit(-1).cast("long").alias("slot"), "number")
    points = spark.range(slots).select(
        van_der_corput(F.col("id")).alias("at"), F.col("id").alias("slot"), F.lit(None).cast("long").alias("number")
    )
    mapped = running(
        bounds.unionByName(points), [], ["at", "slot", "number"], kept, lasts={"taker": F.col("number")}
    ).where("slot >= 0")
    ranked = running(mapped.select("slot", F.col("taker").alias("number")), ["number"], ["slot"], kept, {"rank": F.lit(1)})
    placed = checkpointed(ranked.join(sources.select("number", "source", "blocks"), "number"))
    fitting = placed.where("rank <= blocks").select("slot", "number", (F.col("rank") - 1).alias("block"))
    # As many slots are left over as blocks are without one.
    given = placed.groupBy("number").agg(F.count("*").alias("given"))
    short = sources.join(given, "number", "left").withColumn("given", F.coalesce("given", F.lit(0))).where("given < blocks")
    unplaced = short.select("number", F.explode(F.sequence(F.col("given"), F.col("blocks") - 1)).alias("block"))
    spare = running(placed.where("rank > blocks").select("slot"), [], ["slot"], kept, {"nth": F.lit(1)})
    wanting = running(unplaced, [], ["number", "block"], kept, {"nth": F.lit(1)})
    handed = spare.join(wanting, "nth").select("slot", "number", "block")
    return fitting.unionByName(handed).join(sources.select("number", "source"), "number").select("slot", "source", "block")


def pieces(documents: DataFrame, quotas: DataFrame, block_tokens: int) -> DataFrame:
    """(source, block, doc, start, length): which words of which document a block holds.

    Pass p of a source begins at p times its size, and what lies beyond its quota is left.
    """
    placed = documents.where("size > 0").join(
        quotas.where("quota > 0").select(F.col("source").alias("of"), "source_size", "quota"), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of")
    passes = F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1) / F.col("source_size")).cast("long"))
    read = placed.withColumn("pass", F.explode(passes)).withColumn("at", F.col("pass") * F.col("source_size") + F.col("start"))
    read = read.withColumn("end", F.least(F.col("at") + F.col("size"), F.col("quota"))).where("at < end")
    first, last = F.floor(F.col("at") / block_tokens), F.floor((F.col("end") - 1) / block_tokens)
    cut = read.withColumn("block", F.explode(F.sequence(first, last)))
    begins = F.greatest(F.col("at"), F.col("block") * block_tokens)
    ends = F.least(F.col("end"), (F.col("block") + 1) * block_tokens)
    return cut.select("source", "block", "doc", (begins - F.col("at")).alias("start"), (ends - begins).alias("length"))


def mix(documents: DataFrame, targets: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(slot, source, doc, start, length): the words to read, slot by slot.

    `documents` are those of `sized`; a slot's pieces together hold `block_tokens` words, but
    for the last block of a source.
    """
    quotas = checkpointed(with_quotas(targets, block_tokens))
    slots = schedule(quotas).withColumnsRenamed({"source": "of", "block": "nth"})
    cut = pieces(documents, quotas, block_tokens)
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("nth"))
    return cut.join(slots, same).select("slot", "source", "doc", "start", "length")


def mixed_documents(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per document its size, what its source shall give, and how many words the mix takes of it.

    `pieces` counts the pieces in the mix, `first_slot` is where the first of them stands.
    """
    documents = checkpointed(sized(docs))
    targets = checkpointed(source_targets(documents))
    taken = mix(documents, targets, block_tokens).groupBy("source", "doc").agg(
        F.sum("length").alias("taken"), F.count("*").alias("pieces"), F.min("slot").alias("first_slot")
    ).withColumnsRenamed({"source": "of", "doc": "nth"})
    told = targets.select(F.col("source").alias("for"), "source_size", "target")
    return (
        documents.join(taken, F.col("source").eqNullSafe(F.col("of")) & (F.col("doc") == F.col("nth")), "left")
        .join(told, F.col("source").eqNullSafe(F.col("for")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "source",
                F.coalesce("pieces", F.lit(0)).alias("pieces"), "first_slot")
    )
