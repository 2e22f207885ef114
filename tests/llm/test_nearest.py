"""Nearest neighbours: recall against brute force, exact scores, defined results."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import frame
from tracemill.llm.hnsw import Graph, layer, squared
from tracemill.llm.nearest import nearest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, queries, k):
    ids = np.array([r[0] for r in rows])
    points = np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q in queries:
        far = np.sqrt(((points - points[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, far)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), far[i]) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("shard_size", [60, 4096])
def test_recall_and_scores(spark, shard_size):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    queries = [i for i, _ in rows if i % 10 == 0]
    expected = brute(rows, queries, 10)
    got = found(nearest(vectors, F.col("vec_id") % 10 == 0, shard_size=shard_size))
    assert set(got) == set(expected)
    right = sum(len({v for v, _ in got[q]} & {v for v, _ in expected[q]}) for q in queries)
    assert right / sum(map(len, expected.values())) >= 0.97
    exact = {(q, v): d for q in queries for v, d in brute(rows, [q], len(rows))[q]}
    for q, answers in got.items():
        assert all(d == pytest.approx(exact[q, v], rel=1e-12) for v, d in answers)
        assert answers == sorted(answers, key=lambda x: (x[1], x[0]))


def test_copies_and_vectors_that_take_no_part(spark):
    rows = [(i, [1.0, 2.0]) for i in range(100, 400)] + [(i, [1.0, float(i)]) for i in range(1, 20)]
    rows += [(500, None), (501, []), (502, [0.0, 0.0]), (503, [math.nan, 1.0]), (504, [math.inf, 1.0]), (505, [None, 1.0]), (None, [1.0, 2.0]), (506, [1.0, 2.0, 3.0]), (100, [1.0, 2.0])]
    got = found(nearest(frame(spark, rows, SCHEMA), F.col("vec_id") % 100 == 0, k=10, shard_size=8))
    assert set(got) == {100, 200, 300}
    assert got[100] == [(2, 0.0)] + [(i, 0.0) for i in range(101, 110)]
    assert got[200] == [(2, 0.0)] + [(i, 0.0) for i in range(100, 109)]


def test_few_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0])]
    got = found(nearest(frame(spark, rows, SCHEMA), F.col("vec_id") == 0))
    assert got == {0: [(1, pytest.approx(math.sqrt(2))), (2, pytest.approx(math.sqrt(5)))]}
    assert nearest(frame(spark, [], SCHEMA), F.col("vec_id") == 0).count() == 0
    clash = frame(spark, [(0, [1.0], 1, 2), (1, [2.0], 1, 2)], SCHEMA + ", vector int, id int")
    assert found(nearest(clash, F.col("vec_id") == 0)) == {0: [(1, 1.0)]}


def test_graph_reaches_clusters():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16)) * 10
    points = (centres[rng.integers(0, 30, 1500)] + rng.normal(size=(1500, 16))).astype(np.float32)
    graph = Graph.load(Graph.build(points, 1 - rng.random(1500)).dump())
    queries = points[::25]
    got = graph.search(queries, 10)
    want = np.argsort(squared(queries, points), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(got, want)]) >= 0.97
    links = layer(points[:200], 8, 32)
    assert links.shape == (200, 16) and (links != np.arange(200)[:, None]).all()
