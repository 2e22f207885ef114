"""Mixing: targets against plain arithmetic, quotas met exactly, an even schedule, defined results."""

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import frame, prose, words
from tracemill.llm import mixing as M
from tracemill.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, source string"
SF = "/root/testdata/sf0.001"


def targets(sizes, most=3):
    """Shares by weight; what lies above a cap is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, out, free = sum(sizes.values()), {}, set(sizes)
    while True:
        left = Fraction(total - sum(out.values()))
        level = left / (sum(weight[s] for s in free) or 1)
        above = {s for s in free if level * weight[s] > most * sizes[s]}
        if not above:
            return out | {s: level * weight[s] for s in free}
        out |= {s: Fraction(most * sizes[s]) for s in above}
        free -= above


def taken(rows):
    """Words taken by reading each source's shuffled documents until the target is reached."""
    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        by_source[source].append((hashlib.md5(str(doc_id).encode()).hexdigest()[:15], doc_id, len(words(text))))
    goal = targets({s: sum(n for *_, n in docs) for s, docs in by_source.items()})
    out = []
    for source, docs in by_source.items():
        docs.sort()
        left, got = int(goal[source] + Fraction(1, 2)), Counter()
        for _ in range(3):
            for i, (*_, n) in enumerate(docs):
                got[i] += min(n, left)
                left -= min(n, left)
        size = sum(n for *_, n in docs)
        out += [(d, n, size, float(goal[source]), got[i]) for i, (_, d, n) in enumerate(docs)]
    return sorted(out)


@pytest.fixture(scope="module")
def uneven():
    """A source with most rows, small ones that hit their cap, null, empty and repeated rows."""
    rows = [(i, prose(i, 5 + i * 7 % 60), "hot") for i in range(120)]
    rows += [(1000 + i, prose(i, 12), f"s{i % 7}") for i in range(21)]
    rows += [(2000, None, "s1"), (2001, " \t\n", "s2"), (2002, None, "only null"), (2003, prose(3, 9), None),
             (2004, prose(4, 700), ""), (2004, prose(4, 700), ""), (2005, "é x y", "hot")]
    return rows


@pytest.mark.parametrize("block_tokens", [16, 1024])
def test_taken_words_match_a_plain_reading(spark, uneven, block_tokens):
    got = M.mixed_documents(frame(spark, uneven, SCHEMA), block_tokens)
    rows = sorted(tuple(r[c] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in got.collect())
    assert rows == [pytest.approx(e, rel=1e-12) for e in taken(uneven)]
    assert all(r[4] <= 3 * r[1] for r in rows)


def test_every_slot_holds_one_block_and_sources_are_spread(spark, uneven):
    documents = M.sized(frame(spark, uneven, SCHEMA))
    goal = M.source_targets(documents)
    read = M.mix(documents, goal, 16).collect()
    quotas = {r["source"]: r for r in M.with_quotas(goal, 16).collect()}
    by_slot = defaultdict(list)
    for r in read:
        by_slot[r["slot"]].append(r)
    assert sorted(by_slot) == list(range(sum(q["blocks"] for q in quotas.values())))
    sizes = defaultdict(list)
    for parts in by_slot.values():
        assert len({p["source"] for p in parts}) == 1
        sizes[parts[0]["source"]].append(sum(p["length"] for p in parts))
    for source, held in sizes.items():
        assert sum(held) == quotas[source]["quota"] and len(held) == quotas[source]["blocks"]
        assert sorted(held)[1:] == [16] * (len(held) - 1)
    # Half of the schedule holds each source in about half of its blocks.
    first = Counter(parts[0]["source"] for slot, parts in by_slot.items() if slot < len(by_slot) // 2)
    for source, q in quotas.items():
        assert abs(first[source] - q["blocks"] / 2) <= 4


def test_reruns_agree(spark, uneven):
    df = frame(spark, uneven, SCHEMA)
    first = sorted(M.mixed_documents(df, 16).collect(), key=repr)
    assert sorted(M.mixed_documents(df.repartition(5), 16).collect(), key=repr) == first


def test_empty_tables_and_clashing_columns(spark):
    assert M.mixed_documents(frame(spark, [], SCHEMA)).count() == 0
    nothing = M.mixed_documents(frame(spark, [(1, None, "a"), (2, "", None)], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in nothing] == [(0, 0.0, 0)] * 2
    clash = frame(spark, [(1, "a b c", "x", 5, 6, 7)], SCHEMA + ", size int, slot int, block int")
    assert M.mixed_documents(clash).select("size", "target", "taken").collect() == [(3, 3.0, 3)]


def test_word_counts_cut_at_ascii_white_space_only():
    texts = ["", " ", "a", " a  b\t\r\n", "é b c", "x y", "\x0b\x0c1"]
    assert M.word_counts([t.encode() for t in texts]).tolist() == [len(words(t)) for t in texts]
    assert M.van_der_corput(F.lit(1)) is not None


def test_query_against_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = QUERIES["op13_mixing"](spark, SF)
    expected = duck.execute(ORACLES["op13_mixing"])
    names = [c[0] for c in expected.description]
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == sorted(expected.fetchall())
