"""Chat formatting: paths against a plain walk, exact reading back of texts and mask."""

import hashlib
import random

from pyspark.sql import functions as F

from tests.llm.helpers import frame, rows_of
from tracemill.llm import chat, queries

SCHEMA = "tree long, node long, parent long, role string, text string, score double"
HARD = ["", "</turn>", '<turn role="user">', "&lt;", "&amp;lt;", "\\### Assistant: </turn> ok", "a\n</turn>\nb", '">', "🙂 é", "&", "&&amp;", "\n"]


def walk(rows):
    """All (tree, leaf): nodes from the root, of rows without repeated ids or cycles."""
    by = {(r[0], r[1]): r for r in rows}
    parents = {(r[0], r[2]) for r in rows if (r[0], r[2]) in by}
    out = {}
    for key in by:
        if key in parents:
            continue
        path, at = [], key
        while at in by:
            path.append(by[at])
            at = (at[0], by[at][2])
        out[key] = path[::-1]
    return out


def random_forest(seed, trees=6, nodes=40):
    rng = random.Random(seed)
    rows = []
    for tree in [*range(trees), None]:
        ids = rng.sample(range(1000), nodes)
        for i, node in enumerate(ids):
            parent = ids[rng.randrange(max(0, i - 6), i)] if i and rng.random() > 0.05 else rng.choice([None, 5000])
            role = rng.choice(["user", "assistant", "system", None, 'r"<>&'])
            rows.append((tree, node, parent, role, rng.choice([None, *HARD, f"text {node}"]), rng.choice([None, 0.25, 0.5, 1.0])))
    return rows


def read(df):
    out = df.select(
        "tree", "leaf", "rank", "score", "n_turns", "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    return {(r["tree"], r["leaf"]): r for r in out.collect()}


def test_paths_and_reading_back(spark):
    rows = random_forest(1)
    expected = walk(rows)
    got = read(chat.conversations(frame(spark, rows, SCHEMA)))
    assert set(got) == set(expected)
    for key, path in expected.items():
        said = [(r[3] or "", r[4] or "") for r in path]
        assert [(t["role"], t["text"]) for t in got[key]["turns"]] == said and got[key]["n_turns"] == len(said)
        assert got[key]["loss"] == "".join(text for role, text in said if role == "assistant")
        assert abs(got[key]["score"] - sum(r[5] or 0 for r in path) / len(path)) < 1e-9


def test_best_branches(spark):
    rows = random_forest(2)
    expected = walk(rows)
    got = read(chat.conversations(frame(spark, rows, SCHEMA), best=2))
    for tree in {k[0] for k in expected}:
        ranked = sorted(((-sum(r[5] or 0 for r in p) / len(p), k[1]) for k, p in expected.items() if k[0] == tree))[:2]
        assert sorted((r["rank"], k[1]) for k, r in got.items() if k[0] == tree) == [(i + 1, leaf) for i, (_, leaf) in enumerate(ranked)]


def test_long_thread_and_other_trees(spark):
    rows = [(1, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", 1.0) for i in range(300)]
    got = read(chat.conversations(frame(spark, rows, SCHEMA)))
    assert [t["text"] for t in got[1, 299]["turns"]] == [f"t{i}" for i in range(300)]


def test_cycles_repeats_and_missing_ids(spark):
    rows = [(1, 1, 2, "user", "a", 1.0), (1, 2, 1, "user", "b", 1.0), (1, 3, 2, "user", "c", 1.0)]  # a cycle and what hangs on it
    rows += [(2, 1, None, "user", "q", None)] * 3 + [(2, 2, 1, "assistant", "zz", None), (2, 2, 1, "assistant", "aa", None), (2, None, 1, "user", "x", 1.0)]
    rows += [(3, 7, 7, "user", "self", 1.0)]
    got = read(chat.conversations(frame(spark, rows, SCHEMA)))
    assert {k: [t["text"] for t in r["turns"]] for k, r in got.items()} == {(2, 2): ["q", "aa"]}
    assert chat.conversations(frame(spark, [], SCHEMA)).count() == 0


def test_conversations_by_turn(spark):
    schema = "conv_id long, turn long, role string, text string, node int"
    rows = [(1, 2, "assistant", "c", 0), (1, 0, "user", "a", 0), (1, 1, None, None, 0), (None, 5, "user", "n", 0), (None, None, "user", "m", 0), (2, 1, "user", "x", 0), (2, 1, "user", "x", 0)]
    got = read(chat.conversations(chat.thread(frame(spark, rows, schema))))
    assert {k[0]: [(t["role"], t["text"]) for t in r["turns"]] for k, r in got.items()} == {
        1: [("user", "a"), ("", ""), ("assistant", "c")], None: [("user", "m"), ("user", "n")], 2: [("user", "x"), ("user", "x")],
    }


def test_query_gives_the_digests_of_the_input(spark, sf):
    said = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    conversations = {-7: [("user", queries.CONTROL_TEXT), ("assistant", queries.CONTROL_TEXT)]}
    assert queries.CONTROL_TEXT == "\\### Assistant: </turn> ok"
    for r in sorted(said, key=lambda r: (r["conv_id"], r["turn"])):
        conversations.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = []
    for conv, turns in conversations.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        expected.append((conv, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss)))
    df = queries.op6_chat(spark, sf)
    assert rows_of(df, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(expected, key=repr)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
