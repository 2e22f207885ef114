"""The corpus pipeline stage by stage against brute force, and the registered queries."""

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.helpers import components, frame, grams, jaccard, prose, rows_of, words
from tracemill.llm import queries
from tracemill.llm.tokens import default_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LEAK = "Which of the seven old towers near the river was built before the great flood of spring and who paid for it"


def documents():
    texts = {i: prose(i, 60 + i) for i in range(30)}
    base = prose(900, 150)
    texts |= {100 + i: base.replace("w7 ", f"v{i} ", 1) for i in range(6)} | {110: base, 111: base}
    passage = prose(800, 70)
    texts |= {200 + i: f"{prose(300 + i, 40)}\n{passage}\n{prose(400 + i, 30)}" for i in range(4)}
    texts |= {300: f"{prose(5, 30, 90)} {LEAK} and so on", 301: "1234 --- 5678", 302: "", 303: None, 304: passage, 305: passage + " " + passage}
    return [(i, t, "en" if i % 3 else None, "s", len(t or "")) for i, t in texts.items()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("corpus")
    frame(spark, documents(), SCHEMA).write.parquet(f"{out}/documents.parquet")
    frame(spark, [(1, LEAK), (2, prose(99, 40))], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def expected():
    docs = {i: t for i, t, *_ in documents() if t and any(c.isalpha() for c in t)}
    sets = {i: grams(t) for i, t in docs.items()}
    ids = sorted(docs)
    groups = components(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if jaccard(sets[a], sets[b]) >= 0.8])
    stages = [docs, docs := {i: t for i, t in docs.items() if groups[i] == i}]
    first = {}
    for i in sorted(docs):
        w = words(docs[i])
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    kept = {}
    for i, t in docs.items():
        w = words(t)
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = True
        if not w or not gone.all():
            kept[i] = [x for x, g in zip(w, gone) if not g]
    stages.append(kept)
    stages.append({i: w for i, w in kept.items() if LEAK not in " ".join(w)})
    return stages


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wanted = expected()
    for (_, stage), want in zip(corpus_pipeline.STAGES[:-1], wanted, strict=True):
        docs = stage(spark, docs, folder)
        assert docs.columns == list(corpus_pipeline.DOCUMENT_COLUMNS)
        rows = docs.collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(want)
        if isinstance(next(iter(want.values())), list):
            assert {r["doc_id"]: words(r["text"]) for r in rows} == want
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
        docs = frame(spark, rows, SCHEMA)


def test_run(spark, folder):
    library = Tokenizer.from_file(default_path())
    library.encode_special_tokens = True
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in pieces} == set(expected()[-1])
    total = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert {d: sum(r["length"] for r in pieces if r["doc_id"] == d) for d in total} == total
    untouched = {i: t for i, t, *_ in documents() if i < 30}
    assert all(total[i] == len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in untouched.items())


def test_empty_corpus(spark, folder, tmp_path):
    frame(spark, [], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_has_its_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", queries.ORACLES)
def test_queries_against_duckdb(spark, sf, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    result = connection.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    wanted = result.fetchall()
    df = queries.QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df, *columns) == sorted(wanted, key=repr)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_queries_return_rows(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    assert df.count() > 0 and df.schema == queries.QUERIES[name](spark, sf).schema
