"""Chat formatting: reply trees to training texts, one per chosen root-to-leaf path.

Only DataFrame functions are used. Paths are enumerated by iterative self-joins with doubling
pointers: round k joins the pointers 2**k messages up with themselves, so that a thread of n
messages takes log2(n) rounds; the leaves then gather their ancestors by the same pointers from
the longest down, each ancestor exactly once. Branches of a tree are ranked by score.

The text of a path marks every turn as `<turn role="R">T</turn>` and a line end. Inside R and T
`&`, `<`, `>` and `"` are written as character references, so that marks never occur in
them and `unescaped` gives the exact text back. The loss mask lists the character ranges of
the escaped texts of one role.

Defined results: a null role or text is empty; a message whose parent is null or missing is a
root; repeated messages of one id count once, the smallest role and text winning; messages on
a reply cycle, or that hang below one, belong to no path; null tree ids form one tree; rows
with a null message id are left out, as nothing can reply to them; ties in score go to the
leaf with the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.llm.common import checkpointed

#: Character references of the texts; `&` is written first and read last.
REFERENCES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))
OPEN, MIDDLE, CLOSE = '<turn role="', '">', "</turn>\n"


def escaped(text: Column) -> Column:
    for plain, reference in REFERENCES:
        text = F.replace(text, F.lit(plain), F.lit(reference))
    return text


def unescaped(text: Column) -> Column:
    for plain, reference in reversed(REFERENCES):
        text = F.replace(text, F.lit(reference), F.lit(plain))
    return text


def _pointers(messages: DataFrame) -> list[DataFrame]:
    """(tree, node, up) for 1, 2, 4, ... messages up; the last has no rows."""
    named = messages.select("tree", "node")
    up = messages.where("parent is not null").select("tree", "node", F.col("parent").alias("up"))
    known = named.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    up = up.join(known, up.tree.eqNullSafe(known.t) & (up.up == known.n), "left_semi")
    levels = [checkpointed(up)]
    # A thread without a cycle is over after as many rounds as the messages have binary digits.
    rounds = math.ceil(math.log2(max(2, messages.count()))) + 1
    while len(levels) <= rounds and not levels[-1].isEmpty():
        low, high = levels[-1], levels[-1].select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("top"))
        step = low.join(high, low.tree.eqNullSafe(high.t) & (low.up == high.n)).select("tree", "node", F.col("top").alias("up"))
        levels.append(checkpointed(step))
    return levels


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, back): the messages of each root-to-leaf path, `back` from the leaf,
    of `messages` (tree, node, parent)."""
    levels = _pointers(messages)
    replied = levels[0].select(F.col("tree").alias("t"), F.col("up").alias("n")).distinct()
    leaves = messages.join(replied, messages.tree.eqNullSafe(replied.t) & (messages.node == replied.n), "left_anti")
    # Whoever still has an ancestor after all rounds hangs on a cycle.
    endless = levels[-1].select(F.col("tree").alias("t"), F.col("node").alias("n"))
    leaves = leaves.join(endless, leaves.tree.eqNullSafe(endless.t) & (leaves.node == endless.n), "left_anti")
    found = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back"))
    for k in range(len(levels) - 2, -1, -1):
        up = levels[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        joined = found.join(up, found.tree.eqNullSafe(up.t) & (found.node == up.n), "left")
        here = F.struct(F.col("node").alias("node"), F.col("back").alias("back"))
        above = F.struct(F.col("up").alias("node"), (F.col("back") + (1 << k)).alias("back"))
        both = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, above))
        found = joined.select("tree", "leaf", F.explode(both).alias("at")).select("tree", "leaf", "at.node", "at.back")
    return found


def conversations(messages: DataFrame, loss_role: str = "assistant", best: int | None = None) -> DataFrame:
    """(tree, leaf, score, rank, n_turns, formatted, loss_spans): one row per chosen path.

    `messages` has tree, node, parent, role, text and score. A branch scores the mean of its
    messages' scores, null counting as 0; the `best` branches of each tree are kept, all if None.
    loss_spans are [start, end) characters of `formatted`, the texts of `loss_role`.
    """
    rows = messages.where("node is not null").groupBy("tree", "node").agg(
        F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "parent", "score")).alias("m")
    ).select("tree", "node", "m.*")
    rows = checkpointed(rows)
    placed = paths(rows.select("tree", "node", "parent"))
    said = rows.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text", F.col("score").alias("s"))
    turns = placed.join(said, placed.tree.eqNullSafe(said.t) & (placed.node == said.n)).select("tree", "leaf", "back", "role", "text", "s")
    if best is not None:
        turns = checkpointed(turns)
    scored = turns.groupBy("tree", "leaf").agg(F.avg(F.coalesce("s", F.lit(0.0))).alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
        chosen = ranked.select(F.col("tree").alias("t"), F.col("leaf").alias("l"))
        turns = turns.join(chosen, turns.tree.eqNullSafe(chosen.t) & (turns.leaf == chosen.l), "left_semi")
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MIDDLE))
    turns = turns.withColumn("head", head).withColumn("body", escaped(F.col("text")))
    turns = turns.withColumn("size", F.length("head") + F.length("body") + len(CLOSE))
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("back")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0)) + F.length("head")
    turns = turns.withColumn("start", start).select(
        "tree", "leaf", (-F.col("back")).alias("place"), F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
        (F.col("role") == loss_role).alias("learned"), "start", (F.col("start") + F.length("body")).alias("end"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("place", "piece", "learned", "start", "end")))
    texts = turns.groupBy("tree", "leaf").agg(ordered.alias("turns")).select(
        F.col("tree").alias("t"), F.col("leaf").alias("l"), F.size("turns").cast("long").alias("n_turns"),
        F.array_join("turns.piece", "").alias("formatted"),
        F.transform(F.filter("turns", lambda x: x["learned"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_spans"),
    )
    return ranked.join(texts, ranked.tree.eqNullSafe(texts.t) & (ranked.leaf == texts.l)).drop("t", "l")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text holds."""
    marks = F.filter(F.split(formatted, CLOSE), lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        name = F.regexp_extract(piece, f'^{OPEN}([^"]*){MIDDLE}', 1)
        body = F.substring(piece, F.length(name) + (len(OPEN) + len(MIDDLE) + 1), F.length(piece))
        return F.struct(unescaped(name).alias("role"), unescaped(body).alias("text"))

    return F.transform(marks, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped."""
    parts = F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))))
    return F.array_join(parts, "")


def thread(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages of plain conversations: each row, by turn, replies to the one before.

    Equal turns go by role and text; null turns come first.
    """
    order = Window.partitionBy(conv_id).orderBy(F.col(turn), "role", "text")
    node = F.row_number().over(order).cast("long")
    return rows.select(F.col(conv_id).alias("tree"), node.alias("node"), "role", "text").select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )
