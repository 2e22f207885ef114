"""N-gram Jaccard join against all pairs."""

import random

import pytest

from tests.llm.helpers import components, frame, grams, jaccard, prose, rows_of
from tracemill.llm import ngram_join
from tracemill.llm.ngram_join import choose_bands, similar_documents


def near(text, seed, changes):
    rng = random.Random(seed)
    w = text.split(" ")
    for at in rng.sample(range(len(w)), changes):
        w[at] = f"n{rng.random()}"
    return " ".join(w)


def documents():
    rows = [(i, prose(i, 20 + i % 80)) for i in range(60)]
    base = prose(1000, 200)
    rows += [(100 + i, near(base, i, 3)) for i in range(25)]  # pairs around the threshold
    rows += [(200 + i, base) for i in range(10)]
    other = prose(2000, 60)
    rows += [(300, other), (301, near(other, 1, 1)), (302, other + " tail"), (303, near(other, 2, 8))]
    shared = prose(3000, 90)  # a passage that many share, below the threshold
    rows += [(400 + i, f"{shared} {prose(4000 + i, 80)}") for i in range(20)]
    rows += [(500, "one two"), (501, "one two"), (502, "one  two\n"), (503, "two one"), (504, ""), (505, None), (506, " \n")]
    return rows


def brute(rows):
    sets = {doc: grams(text) for doc, text in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if jaccard(sets[a], sets[b]) >= 0.8]
    classes = {doc: min(d for d in ids if sets[d] == sets[doc]) if sets[doc] else doc for doc in ids}
    return classes, components(ids, links), links


def test_matches_all_pairs(spark):
    rows = documents()
    classes, groups, links = brute(rows)
    got = similar_documents(frame(spark, rows))
    assert rows_of(got, "doc_id", "class_id", "group_id") == sorted(((d, classes[d], groups[d]) for d in classes), key=repr)
    linked = {r["doc_id"] for r in got.where("n_links > 0").collect()}
    different = {d for a, b in links if classes[a] != classes[b] for d in (a, b)}
    assert linked <= different and {groups[d] for d in linked} == {groups[d] for d in different}


def test_buckets_that_hold_several_groups_are_decided(spark, monkeypatch):
    # One band of one row puts nearly everything into the same buckets.
    monkeypatch.setattr(ngram_join, "choose_bands", lambda *_: (1, 1))
    rows = [r for r in documents() if 100 <= r[0] < 110 or 400 <= r[0]]
    classes, groups, _ = brute(rows)
    got = {r["doc_id"]: r["group_id"] for r in similar_documents(frame(spark, rows)).collect()}
    together = {(a, b) for a in got for b in got if got[a] == got[b]}
    assert together <= {(a, b) for a in groups for b in groups if groups[a] == groups[b]}


@pytest.mark.parametrize("block", [1024, 4])
def test_links_are_counted_like_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join.link_counts, "__defaults__", (block, ngram_join.GROUP_BYTES))
    base = prose(5000, 300)
    rows = documents() + [(600 + i, near(base, 7000 + i, 4)) for i in range(30)]  # a group that its pivot connects
    classes, _, links = brute(rows)
    partners = {d: set() for d in classes}
    for a, b in links:
        if classes[a] != classes[b]:
            partners[a].add(classes[b])
            partners[b].add(classes[a])
    got = {r["doc_id"]: r["n_links"] for r in similar_documents(frame(spark, rows)).collect()}
    assert max(got.values()) > 10
    assert got == {d: len(found) for d, found in partners.items()}


@pytest.mark.parametrize("block", [1024, 5])
def test_links_far_from_the_pivot_are_counted(spark, monkeypatch, block):
    # A chain: each text differs a little from the one before, the ends are not linked.
    monkeypatch.setattr(ngram_join.link_counts, "__defaults__", (block, ngram_join.GROUP_BYTES))
    text, rows = prose(9000, 150), []
    for i in range(24):
        rows.append((i, text))
        text = near(text, i, 1)
    rows += [(100 + i, rows[12][1] + f" tail{i}") for i in range(12)]  # all near one text: settled without comparing
    _, groups, links = brute(rows)
    got = {r["doc_id"]: (r["group_id"], r["n_links"]) for r in similar_documents(frame(spark, rows)).collect()}
    assert got == {d: (groups[d], sum(d in link for link in links)) for d in groups}
    assert min(n for _, n in got.values()) < 12 < max(n for _, n in got.values())


def test_further_links_merge_labels(spark):
    labels = spark.createDataFrame([(b"a", b"a"), (b"b", b"a"), (b"c", b"c"), (b"d", b"c"), (b"e", b"e"), (b"f", b"e")], "node binary, label binary")
    more = spark.createDataFrame([(b"b", b"d", 0.9), (b"d", b"x", 0.8), (b"y", b"z", 0.8)], "a binary, b binary, similarity double")
    got = {bytes(r["node"]): bytes(r["label"]) for r in ngram_join._merged(labels, more).collect()}
    assert got == {b"a": b"a", b"b": b"a", b"c": b"a", b"d": b"a", b"x": b"a", b"e": b"e", b"f": b"e", b"y": b"y", b"z": b"y"}
    assert ngram_join._merged(labels, more.limit(0)).count() == 6


@pytest.mark.parametrize("recall", [0.9, 0.99, 0.999])
def test_bands_reach_the_recall(recall):
    bands, rows = choose_bands(0.8, recall)
    assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= ngram_join.MAX_HASHES
    assert choose_bands(1.0, recall)[0] == 1


def test_edges(spark):
    assert similar_documents(frame(spark, [])).count() == 0
    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (None, "a b c d e f g", "z")]
    got = similar_documents(frame(spark, rows, "doc_id long, text string, class string"))
    assert rows_of(got, "doc_id", "class_id", "group_id", "n_copies", "n_links") == [(1, 1, 1, 1, 0), (2, 1, 1, 1, 0), (None, None, None, 0, 0)]


def test_a_recall_out_of_reach_is_an_error():
    with pytest.raises(ValueError, match="recall"):
        choose_bands(0.01, 0.999)
    assert choose_bands(0.01, 0.999, 10_000)[1] >= 1
