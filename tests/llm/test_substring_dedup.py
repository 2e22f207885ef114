"""Substring dedup against a window-by-window version."""

import random

import pytest

from tests.llm.helpers import frame, prose, rows_of, words
from tracemill.llm.substring_dedup import covered_ranges, remove_repeats


def brute(rows, window):
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, None if text is None else kept, len(w), sum(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "anchor", "vocabulary", "bits"), [(5, 2, 4, 12), (4, 4, 30, 6), (7, 3, 200, 18), (1, 1, 50, 12)])
def test_matches_brute_force(spark, window, anchor, vocabulary, bits):
    rng = random.Random(window)
    passage = prose(1, 40, vocabulary)
    rows = [(i, prose(100 + i, rng.randrange(60), vocabulary)) for i in range(40)]
    rows += [(100 + i, f"{prose(i, 9, vocabulary)}\n{passage}\t {prose(i + 7, rng.randrange(9), vocabulary)}") for i in range(12)]
    rows += [(200 + i, passage) for i in range(5)] + [(7, passage), (7, rows[3][1])]
    rows += [(300, None), (301, ""), (302, " \n "), (None, passage), (303, "é" + passage + " ü"), (304, "x " * 500)]
    rows += [(305, "x " * 300), (300, None)]
    got = remove_repeats(frame(spark, rows), window=window, anchor=anchor, bits=bits)
    assert rows_of(got, "doc_id", "text", "n_words", "n_removed") == brute(rows, window)


def test_layout_keeps_white_space_of_what_stays(spark):
    passage = prose(5, 12, 100)
    rows = [(1, passage), (2, f"a\n\nb  {passage}\n\nc\td\n"), (3, "  left as\n it is ")]
    got = {r["doc_id"]: r["text"] for r in remove_repeats(frame(spark, rows), window=10, anchor=4, bits=12, layout=True).collect()}
    assert got == {1: passage, 2: "a\n\nb  c\td\n", 3: "  left as\n it is "}


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, version int, ranges string, doc double, n_words string, anchor int"
    assert remove_repeats(frame(spark, [], schema)).count() == 0
    passage = prose(5, 60)
    rows = [(i, passage, i, "r", 0.5, "old", 9) for i in (2, 1)]
    got = rows_of(remove_repeats(frame(spark, rows, schema)), "doc_id", "text", "version", "ranges", "doc", "n_words", "n_removed", "anchor")
    assert got == [(1, passage, 1, "r", 0.5, 60, 0, 9), (2, "", 2, "r", 0.5, 60, 60, 9)]


def test_very_long_text(spark):
    long = prose(9, 300_000, 1000)
    rows = [(1, long), (2, long[: len(long) // 2] + " end")]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in remove_repeats(frame(spark, rows)).collect()}
    assert got[1] == (300_000, 0)
    assert got[2][1] >= got[2][0] - 2


def test_ranges_do_not_grow_with_repeated_rows(spark):
    text = " ".join(f"{prose(1, 60)} {prose(40 + i, 60)}" for i in range(5))
    sizes = []
    for n in (1, 1000):
        rows = spark.createDataFrame([(1, prose(1, 60), 0)] + [(2, text, 1)] * n, "doc long, text string, version long")
        found = covered_ranges(rows, bits=12).collect()
        assert [(r["doc"], r["version"]) for r in found] == [(2, 1)]
        sizes.append(len(found[0]["ranges"]))
    assert sizes[0] == sizes[1] > 0
