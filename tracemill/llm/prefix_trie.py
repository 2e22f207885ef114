"""All prefixes of conversations at once: a trie by Spark SQL's ROLLUP over turn-id columns.

A turn's id is the first 128 bits of the SHA-256 digest of its role and text, taken while the
table is read, so that no text is shuffled. Each conversation becomes rows of BLOCK positional
columns t1 .. t8, one row for every eight turns. One ROLLUP over these columns, keyed by the node
at which the block begins, yields every node of the trie: grouping_id tells a node's depth inside
its block, map-side combine shrinks a prefix that a third of all conversations share. A long
conversation continues in further blocks; the node where a block begins is a digest of all blocks
before it, found for all blocks of all conversations by doubling: round r combines 2**r blocks.
The last column of a full block holds that digest instead of the turn's own id, which makes both
ends of the seam the same node.

Nothing walks the trie. A node belongs to its smallest member; what a member owns of its own path
is the part below some depth. A subtree's leaves are the members that own the leaf they end in, and
the sum of (members - 1) times bytes over a subtree is, summed over members, the bytes of the turns
from the node's own down to the first one that the member owns. Both are sums over members, and a
second ROLLUP takes them.

Defined results: rows without a conversation id take no part. Null roles and texts are empty. Turns are ordered by
turn number, null first, then by digest; repeated rows are turns of their own. A conversation
without turns is a member of the root alone. An empty table gives no rows, not even a root. Only
`conv_id`, `turn`, `role` and `text` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.llm.common import checkpointed
from tracemill.operators.ranges import running

#: Turns of one row of positional columns.
BLOCK = 8
#: Ids that one string holds while a list of them is digested.
LISTED = 256
IDS = [f"t{k}" for k in range(1, BLOCK + 1)]
SIZES = [f"b{k}" for k in range(1, BLOCK + 1)]
NOTHING = hashlib.sha256(b"").hexdigest()


def digest(*values: Column) -> Column:
    """128 bits of the SHA-256 digest of the values, one after the other."""
    return F.substring(F.unhex(F.sha2(F.concat(*values), 256)), 1, 16)


ROOT = bytes(16)


def numbered(said: DataFrame) -> DataFrame:
    """(conv_id, position, id, bytes): turns counted from 1 on; `bytes` are those of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told_apart = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = said.where("conv_id is not null").select(
        "conv_id", "turn", digest(told_apart).alias("id"), F.octet_length(text).cast("long").alias("bytes")
    )
    placed = running(
        turns, ["conv_id"], [F.col("turn").asc_nulls_first(), "id"], lambda df, _: checkpointed(df), {"position": F.lit(1)}
    )
    return placed.select("conv_id", "position", "id", "bytes")


def branched(turns: DataFrame, heads: int = 9, every: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others, and their ids; `turns` are those of `numbered`.

    Conversation c has the first h turns of conversation c - c % every, as far as there are any,
    then its own after its first h; h is crc32 of the number in decimals, modulo `heads`. Such
    tables hold what a chat with regenerated answers holds: long prefixes in common.
    """
    convs = checkpointed(turns.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
    ))
    first = turns.where(F.col("position") < heads).withColumnRenamed("conv_id", "base")
    borrowed = convs.join(first, "base").where("position <= h").select("conv_id", "position", "id", "bytes")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    shift = convs.join(bases, "base", "left").select(
        "conv_id", "h", (F.least("h", F.coalesce("there", F.lit(0))) - F.col("h")).alias("shift")
    )
    own = turns.join(shift, "conv_id").where("position > h").select(
        "conv_id", (F.col("position") + F.col("shift")).alias("position"), "id", "bytes"
    )
    return borrowed.unionByName(own), convs.select("conv_id")


def blocks_of(turns: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, n_turns, block, t1 .. t8, b1 .. b8): every conversation has a first block."""
    at = F.col("position") - 1
    slot = (at % BLOCK).alias("slot")
    placed = turns.select("conv_id", F.floor(at / BLOCK).alias("block"), slot, "id", "bytes").unionByName(
        members.select("conv_id", F.lit(0).cast("long").alias("block")), allowMissingColumns=True
    )
    here = [F.col("slot") == k for k in range(BLOCK)]
    blocks = placed.groupBy("conv_id", "block").agg(
        *[F.max(F.when(h, F.col("id"))).alias(name) for h, name in zip(here, IDS)],
        *[F.coalesce(F.sum(F.when(h, F.col("bytes"))), F.lit(0)).alias(name) for h, name in zip(here, SIZES)],
        F.count("slot").alias("filled"),
    )
    lengths = blocks.groupBy("conv_id").agg(F.sum("filled").alias("n_turns"))
    return blocks.join(lengths, "conv_id")


def path(upto: int) -> Column:
    """The ids t1 .. t(upto) in a row; null ids, which only end a block, are left out."""
    return F.concat_ws("", *[F.hex(name) for name in IDS[:upto]])


def chained(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, through, bytes_through): digest and bytes of a conversation up to each block's end.

    Only conversations of more than one block are looked at. After round r a row stands for the
    2**r blocks up to its own; the number of rounds is the logarithm of the longest one's blocks.
    """
    size = sum((F.col(name) for name in SIZES), F.lit(0))
    state = checkpointed(blocks.where(F.col("n_turns") > BLOCK).select(
        "conv_id", "block", digest(path(BLOCK)).alias("through"), size.alias("bytes_through")
    ))
    longest = state.agg(F.max("block")).first()[0] or 0
    for step in (1 << r for r in range(int(longest).bit_length())):
        before = state.select(
            "conv_id", (F.col("block") + step).alias("block"),
            F.col("through").alias("head"), F.col("bytes_through").alias("head_bytes"),
        )
        both = F.when(F.col("head").isNull(), F.col("through")).otherwise(digest(F.col("head"), F.col("through")))
        state = checkpointed(state.join(before, ["conv_id", "block"], "left").select(
            "conv_id", "block", both.alias("through"),
            (F.col("bytes_through") + F.coalesce("head_bytes", F.lit(0))).alias("bytes_through"),
        ))
    return state


def seamed(blocks: DataFrame) -> DataFrame:
    """`blocks` with the node they begin at, `prior`, and c0 .. c8, the bytes of the path up to each turn."""
    links = chained(blocks)
    through = links.select("conv_id", "block", "through")
    prior = links.select("conv_id", (F.col("block") + 1).alias("block"), F.col("through").alias("prior"), F.col("bytes_through").alias("c0"))
    joined = blocks.join(through, ["conv_id", "block"], "left").join(prior, ["conv_id", "block"], "left")
    # A block of a conversation that has no other is as deep as the first one of a longer one.
    seam = F.when(F.col(IDS[-1]).isNotNull(), F.coalesce("through", digest(path(BLOCK))))
    c = [F.coalesce("c0", F.lit(0))]
    for name in SIZES:
        c.append(c[-1] + F.col(name))
    return joined.select(
        "conv_id", "n_turns", "block", F.coalesce("prior", F.lit(ROOT)).alias("prior"),
        *IDS[:-1], seam.alias(IDS[-1]), *[v.alias(f"c{k}") for k, v in enumerate(c)],
    )


def node(depth_in_block: int) -> Column:
    """The node that a block's first ids lead to."""
    if depth_in_block == 0:
        return F.col("prior")
    if depth_in_block == BLOCK:
        return F.col(IDS[-1])
    return digest(F.hex("prior"), path(depth_in_block))


def by_level(level: Column, value) -> Column:
    out = value(0)
    for k in range(1, BLOCK + 1):
        out = F.when(level == k, value(k)).otherwise(out)
    return out


def rolled_up(blocks: DataFrame, aggregates: str) -> DataFrame:
    """One row per node: `key`, `parent`, `depth`, `level` inside the block, and the aggregates."""
    columns = ", ".join(IDS)
    grouped = blocks.sparkSession.sql(
        f"SELECT block, prior, {columns}, {aggregates}, grouping_id() AS gid"
        f" FROM {{blocks}} GROUP BY block, prior, ROLLUP ({columns})",
        blocks=blocks,
    )
    # grouping_id has a bit for each column that is rolled up.
    level = (BLOCK - F.bit_count("gid")).alias("level")
    found = grouped.select("*", level)
    # Shorter conversations leave a null where the block goes on; a seam is a node of the block before.
    real = by_level(F.col("level"), lambda k: F.col(IDS[k - 1]).isNotNull() if k else F.col("block") == 0)
    return found.where(real).select(
        "*", (F.col("block") * BLOCK + F.col("level")).alias("depth"),
        by_level(F.col("level"), node).alias("key"),
        by_level(F.col("level"), lambda k: node(k - 1) if k else F.lit(None).cast("binary")).alias("parent"),
    )


def listed_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of `ends` (key, conv_id): SHA-256 of the ids in order, comma between them.

    Ids are sorted in ranges and joined to short strings there; a digest then reads the strings of
    its node one after the other, so that no task holds a list, however many ids it has.
    """
    text = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("first", T.LongType()), T.StructField("ids", T.StringType())])
    told = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, key, ids = [], None, []
            for k, i in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if k != key or len(ids) == LISTED:
                    if ids:
                        rows.append((key, ids[0], ",".join(map(str, ids))))
                    key, ids = k, []
                ids.append(i)
            if ids:
                rows.append((key, ids[0], ",".join(map(str, ids))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.string()))] if rows else
                [pa.array([], t) for t in (pa.binary(), pa.int64(), pa.string())], names=text.names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if state is not None and k == key:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[n] for d in done], t) for n, t in enumerate((pa.binary(), pa.string()))], names=told.names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=told.names)

    strings = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(join, text)
    return strings.repartition("key").sortWithinPartitions("key", "first").mapInArrow(read, told)


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations `members` (conv_id long) with `turns`.

    conv_id is the smallest member; n_convs, n_children, n_leaves and saved_tokens (bytes that
    members share, over the subtree) are as described above; ends_sha256 tells who ends here.
    """
    blocks = checkpointed(seamed(checkpointed(blocks_of(turns, members))))
    c = ", ".join(f"min(c{k}) AS c{k}" for k in range(BLOCK + 1))
    nodes = checkpointed(rolled_up(
        blocks, f"min(conv_id) AS conv_id, count(*) AS n_convs, max(n_turns) AS longest, {c}"
    ).select(
        "key", "parent", "depth", "conv_id", "n_convs", (F.col("longest") == F.col("depth")).alias("is_leaf"),
        by_level(F.col("level"), lambda k: F.col(f"c{max(k - 1, 0)}")).alias("before"),
    ))
    # What a conversation owns begins with one node; `before` are the bytes of the path above it.
    owned = checkpointed(nodes.groupBy("conv_id").agg(
        F.min(F.struct("depth", "parent", "before")).alias("top"), F.bool_or("is_leaf").alias("owns_leaf")
    ).select("conv_id", "top.*", "owns_leaf"))
    reached = F.max(F.col(f"c{BLOCK}")).alias("whole")
    shared = blocks.groupBy("conv_id").agg(reached).join(owned.select("conv_id", "before", "owns_leaf"), "conv_id", "left").select(
        "conv_id", F.coalesce("before", "whole").alias("shared"), F.coalesce("owns_leaf", F.lit(False)).cast("long").alias("leaf"),
    )
    sums = ", ".join(f"sum(greatest(shared - c{k}, 0)) AS s{k}" for k in range(BLOCK))
    subtrees = rolled_up(blocks.join(shared, "conv_id"), f"sum(leaf) AS n_leaves, {sums}").select(
        "key", "n_leaves", by_level(F.col("level"), lambda k: F.col(f"s{max(k - 1, 0)}")).alias("saved_tokens")
    )
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    # Below its first own node, a conversation owns the parent too.
    parents = owned.where("parent is not null").join(
        nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("above")), "parent"
    ).select("conv_id", "depth", "above")
    last = blocks.where(F.col("block") == F.greatest(F.ceil(F.col("n_turns") / BLOCK) - 1, F.lit(0)))
    ends = last.select(by_level(F.col("n_turns") - F.col("block") * BLOCK, node).alias("key"), "conv_id")
    return (
        nodes.join(subtrees, "key").join(children, "key", "left").join(listed_digests(ends), "key", "left")
        .join(parents, ["conv_id", "depth"], "left")
        .select(
            "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"), "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
        )
    )
