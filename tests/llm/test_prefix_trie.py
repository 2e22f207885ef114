"""The trie of prefixes against plain dictionaries, long conversations, defined results."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import frame
from tracemill.llm import prefix_trie as P
from tracemill.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.001"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def by_conversation(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append(((turn is not None, turn or 0, key(role, text)), (role, text)))
    return {c: [said for _, said in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        turns = tuple(convs[c])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(((
        m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
        hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items()), key=repr)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def said():
    """One first turn shared by most, copies, a very long one, ties, nulls, repeated rows."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"é{t % 3 if t else 0} {c % 4 if t > 2 else ''}") for c in range(60) for t in range(c % 12)]
    rows += [(c, t, "user", f"long {t}") for c in (100, 101, 102) for t in range(70 - (c == 101) * 6)]
    rows += [(100 + c, t, "user", f"long {t}") for c in (5, 6) for t in range(16)]
    rows += [(200, None, "b", "x"), (200, None, "a", "x"), (200, 1, None, None), (200, 1, None, None), (None, 0, "user", "no id")]
    rows += [(203, 0, "", ""), (204, 0, "1:", "x"), (205, 0, "1", ":x"), (-3, 0, "user", "é0 ")]
    return rows


def test_rebuilt_conversations(spark, said):
    turns = P.numbered(frame(spark, said, SCHEMA))
    again, ids = P.branched(turns)
    expected = rebuilt({c: v for c, v in by_conversation(said).items() if c >= 0})
    read = defaultdict(list)
    for r in again.where("conv_id >= 0").orderBy("conv_id", "position").collect():
        read[r["conv_id"]].append((r["position"], bytes(r["id"])))
    assert {c: [(i + 1, key(*t)) for i, t in enumerate(v)] for c, v in expected.items() if v} == read
    assert {r[0] for r in ids.collect()} == set(by_conversation(said))


def test_nodes_match_plain_dictionaries(spark, said):
    rows = [r for r in said if r[0] is None or r[0] >= 0]
    turns = P.numbered(frame(spark, rows, SCHEMA))
    assert got(P.trie(*P.branched(turns))) == plain(rebuilt(by_conversation(rows)))


def test_conversations_as_they_are(spark, said):
    turns = P.numbered(frame(spark, said, SCHEMA))
    members = turns.select("conv_id").distinct().union(frame(spark, [(900,), (901,)], "conv_id long"))
    assert got(P.trie(turns, members)) == plain(by_conversation(said) | {900: [], 901: []})


def test_empty_table_and_clashing_columns(spark):
    turns = P.numbered(frame(spark, [], SCHEMA))
    assert P.trie(*P.branched(turns)).count() == 0
    clash = frame(spark, [(0, 0, "user", "hi", 1, b"2", 3)], SCHEMA + ", position int, id binary, block int")
    assert got(P.trie(*P.branched(P.numbered(clash)))) == plain(rebuilt({0: [("user", "hi")]}))


def test_lists_of_ids_are_read_in_order(spark, monkeypatch):
    ids = spark.range(2000).select(F.when(F.col("id") < 5, F.lit(b"a")).otherwise(F.lit(b"b")).alias("key"), F.col("id").alias("conv_id"))
    monkeypatch.setattr(P, "LISTED", 7)
    told = {bytes(r["key"]): r["ends_sha256"] for r in P.listed_digests(ids.repartition(5)).collect()}
    assert told == {k: hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for k, r in ((b"a", range(5)), (b"b", range(5, 2000)))}


def test_query_against_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    result = QUERIES["op11_prefix_trie"](spark, SF)
    expected = duck.execute(ORACLES["op11_prefix_trie"])
    assert result.columns == [c[0] for c in expected.description]
    assert [t for _, t in result.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(map(repr, map(tuple, result.collect()))) == sorted(map(repr, expected.fetchall()))
