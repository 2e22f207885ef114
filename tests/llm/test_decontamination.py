"""Decontamination against a version that aligns every document with every item."""

import random

from pyspark.sql import functions as F

from tests.llm.helpers import frame, prose, rows_of
from tracemill.llm import decontamination as D

ITEMS = [
    (1, "Natalia sold 48 clips to her friends in April, and then she sold half as many clips in May. How many did Natalia sell?"),
    (2, "A train runs 120 km in 2 hours and after that another 120 km in 3 hours. What is the mean speed over the whole way?"),
    (3, "Of. Ou thtionea from eainan ertionnd bleea rely. Tiin reed ingly inre erstes.\nErouha to handin tiwh onedanble."),
    (4, "Seven short words stand in this item"),
    (5, "Too short an item"),
    (6, None), (7, ""),
    (8, "A train runs 120 km in 2 hours and after that another 120 km in 3 hours. What is the mean speed over the whole way?"),
]


def hits(spark, rows, items=ITEMS, **options):
    found = D.contaminated(frame(spark, rows), frame(spark, items, "item_id long, text string"), **options)
    return {(r["doc_id"], r["item_id"]): r for r in found.collect()}


def test_copies_and_re_parameterised_questions(spark):
    train = ITEMS[1][1]
    rows = [
        (1, f"{prose(1, 30)} {ITEMS[0][1]} {prose(2, 30)}"),
        (2, f"Intro. {train.replace('120', '90').replace(' 2 ', ' 4 ')}"),  # both 120 became 90
        (3, f"Intro. {train.replace('120', '90', 1)}"),  # one of them: 120 stands for two values
        (4, f"Intro. {train.replace('km', 'miles')}"),  # another unit, throughout
        (5, "Intro. " + ITEMS[0][1].replace("48", "31").replace("Natalia", "Marco").replace("April", "June")),
        (6, ITEMS[2][1].lower().replace(".", " ,")), (7, prose(7, 300)), (8, None), (9, ""), (None, train), (1, rows_text()),
        (10, "x " + " ".join(ITEMS[2][1].split()[2:]) + " y"), (11, " ".join(ITEMS[2][1].split()[:8])),
        (12, "they said: seven short words stand in this item, yes"), (13, ITEMS[4][1]),
    ]
    got = hits(spark, rows)
    certain = {(1, 1), (1, 3), (2, 2), (2, 8), (4, 2), (4, 8), (5, 1), (6, 3), (10, 3), (12, 4)}
    # Document 3 holds exact runs of the question, but no mapping for the whole of it.
    assert certain <= set(got) <= certain | {(3, 2), (3, 8)}
    assert got[1, 1]["same_values"] and not got[2, 2]["same_values"] and not got[5, 1]["same_values"]
    assert got[2, 2]["n_matched"] == got[2, 2]["n_item"]
    assert all(r["n_matched"] < r["n_item"] for k, r in got.items() if k[0] == 3)


def rows_text():
    return "again " + ITEMS[2][1]


def test_slots_must_map_one_to_one(spark):
    item = [(1, "first 5 red balls then 5 blue balls and after that 7 green balls are drawn at random")]
    text = "first {} red balls then {} blue balls and after that {} green balls are drawn at random"
    rows = [(i, text.format(*v)) for i, v in enumerate([(5, 5, 7), (8, 8, 9), (8, 9, 7), (8, 8, 8), (7, 7, 5)])]
    got = hits(spark, rows, item, run=17)
    assert set(got) == {(0, 1), (1, 1), (4, 1)}
    assert [got[i, 1]["same_values"] for i in (0, 1, 4)] == [True, False, False]
    assert got[0, 1]["n_slots"] == 2


def test_copies_in_another_case(spark):
    item = ITEMS[0][1]
    rows = [(1, f"so {item.lower()}"), (2, item.upper()), (3, "So " + item.title()), (4, item.upper().replace("48", "31"))]
    got = hits(spark, rows)
    assert set(got) == {(i, 1) for i in (1, 2, 3, 4)}
    assert all(r["n_matched"] == r["n_item"] for r in got.values())
    assert [got[i, 1]["same_values"] for i in (1, 2, 3, 4)] == [True, True, True, False]
    capital = [(1, item.upper())]
    assert set(hits(spark, [(1, item), (2, item.lower()), (3, item.upper())], capital)) == {(1, 1), (2, 1), (3, 1)}


def test_the_longest_consistent_run_is_found(spark):
    # Both 2 and 3 became 4: only the tokens before the second 4, or after the first, map one to one.
    train = ITEMS[1][1]
    rows = [(1, train.replace(" 2 ", " 4 ").replace(" 3 ", " 4 ")), (2, "Intro. " + train.replace("120", "90", 1))]
    got = hits(spark, rows, ITEMS[1:2])
    w = rows[0][1].replace(".", "").replace("?", "").split()
    assert set(got) == {(1, 2), (2, 2)}
    second = [i for i, x in enumerate(w) if x == "4"]
    assert got[1, 2]["n_matched"] == max(second[1], len(w) - second[0] - 1) and not got[1, 2]["same_values"]


def test_first_word_of_a_short_item_as_a_name(spark):
    items = [(1, "What is the capital of France"), (2, "Which of Ann or Bob has more than three apples")]
    rows = [(1, "Then they asked What is the capital of France"), (2, "what is the capital of france"), (3, "he said, Which of Cleo or Dan has more than three apples, then")]
    assert set(hits(spark, rows, items)) == {(1, 1), (2, 1), (3, 2)}


def test_short_items_are_found_as_copies(spark):
    items = [(1, "Who wrote the play Hamlet"), (2, "Ann ran 5 km"), (3, "yes"), (4, "?"), (5, None), (6, ITEMS[0][1]), (7, "who wrote the play hamlet?")]
    rows = [
        (1, "So: who wrote the play Hamlet?"), (2, "then ann ran 5km, YES"), (3, "Ann ran 6 km"), (4, "eyes"), (5, "who wrote a play"),
        (6, "yes"), (7, None), (8, ""), (9, f"{ITEMS[0][1]} Yes. yes"), (None, "yes"), (10, "WHO WROTE THE PLAY HAMLET"), (10, "no"), (11, "yes"), (11, "yes"),
    ]
    got = hits(spark, rows, items, short=True)
    assert set(got) == {(1, 1), (1, 7), (2, 2), (2, 3), (6, 3), (9, 3), (9, 6), (10, 1), (10, 7), (11, 3)}
    assert [(got[k]["n_matched"], got[k]["n_item"], got[k]["first_token"], got[k]["same_values"]) for k in ((1, 1), (2, 3))] == [(5, 5, 1, True), (1, 1, 5, True)]
    assert set(hits(spark, rows, items)) == {(9, 6)}


def test_short_items_like_brute_force(spark):
    items = [(i, prose(900 + i, 1 + i % 5, 12)) for i in range(15)]
    rows = [(i, prose(i, i % 40, 12)) for i in range(60)]
    expected = {(d, i) for d, text in rows for i, item in items if f" {item} " in f" {text} "}
    assert set(hits(spark, rows, items, short=True)) == expected and len(expected) > 100


def test_every_offset_and_run_length_is_found(spark):
    rng = random.Random(3)
    item = prose(77, 40, 10_000)
    w = item.split()
    rows, expected = [], set()
    for doc in range(120):
        n, at = rng.randrange(8, 25), rng.randrange(0, 15)
        part = " ".join(w[at : at + n])
        rows.append((doc, f"{prose(doc, rng.randrange(1, 30))} {part} {prose(500 + doc, rng.randrange(1, 30))}"))
        if len(w[at : at + n]) >= D.RUN:
            expected.add((doc, 1))
    assert set(hits(spark, rows, [(1, item)])) == expected


def test_templates_align_with_their_tokens(spark):
    texts = [t for _, t in ITEMS if t] + ["5.Foo x5y 3,000.5km 12:30 a.b 7. End 4 km/h 1/2", "He met Ann Lee, then Bob; 3 Kings", "ÄÖ 5€ in Köln 2. Satz", "1 2 3"]
    df = frame(spark, list(enumerate(texts))).select(D.marked(F.col("text")).alias("m")).select(D.tokens(F.col("m")).alias("a"), D.template(F.col("m")).alias("b"))
    for r in df.collect():
        assert len(r["a"]) == len(r["b"])
        assert all(x == y or x[0] == y and len(x) > 1 for x, y in zip(r["a"], r["b"]))


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    rows = [(i, f"{prose(i, 20)} {ITEMS[2][1]}") for i in range(5)]
    broadcast = set(hits(spark, rows))
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", -1)
    assert set(hits(spark, rows)) == broadcast == {(i, 3) for i in range(5)}


def test_empty_tables(spark):
    assert hits(spark, []) == {} and hits(spark, [(1, ITEMS[0][1])], []) == {}
    extra = frame(spark, [(1, "x " + ITEMS[2][1], 3, "p")], "doc_id long, text string, item_id int, plain string")
    assert rows_of(D.contaminated(extra, frame(spark, ITEMS, "item_id long, text string")), "doc_id", "item_id") == [(1, 3)]


def test_planted_passages(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).collect()}
    texts = {r["item_id"]: " ".join(r["text"].split()) for r in items.collect()}
    planted = {(r["doc_id"], i) for r in docs.collect() for i, t in texts.items() if t in " ".join((r["text"] or "").split())}
    assert planted and planted <= got
    assert len(got) <= len(planted) + 10
