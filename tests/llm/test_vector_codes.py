"""Vector codes: the fit against plain comparison of everything, defined results, the curve."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import frame
from tracemill.llm import vector_codes as V
from tracemill.llm.hilbert import places
from tracemill.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"
SF = "/root/testdata/sf0.001"


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(r[1]) for r in kept), default=0) // parts)
    whole = [[math.floor(4096 * x) for x in r[1]] + [0] * (width * parts - len(r[1])) for r in kept]
    pieces = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[v[p] for v in pieces[:entries]] for p in range(parts)]

    def assign(p, piece):
        return min((sum((a - b) ** 2 for a, b in zip(piece, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            taken = {}
            for v in pieces:
                taken.setdefault(assign(p, v[p])[1], []).append(v[p])
            for k, members in taken.items():
                books[p][k] = tuple(sum(c) // len(members) for c in zip(*members))
    told = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for r, v in zip(kept, pieces):
        best = [assign(p, v[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[r[2]] = by_label.get(r[2], 0) + error
        out.append((r[0], r[2], "".join(f"{k:02x}" for _, k in best), error))
    return sorted(((i, code, e, by_label[label], told) for i, label, code, e in out), key=repr)


def got(df):
    columns = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def clustered():
    """Clusters, many copies of one vector, ties, and rows that take no part."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    rows = [(i, [float(x) for x in centres[i % 20] + rng.normal(size=16) * (0.01 if i % 3 else 0.5)], i % 4) for i in range(300)]
    rows += [(300 + i, [0.25] * 16, None) for i in range(150)]
    rows += [(500 + i, [float((i >> k & 1) * 2 - 1) / 4096 for k in range(16)], 9) for i in range(40)]
    rows += [(600, None, 1), (601, [math.nan] * 16, 1), (602, [None] + [1.0] * 15, 1), (603, [-math.inf] * 16, 1)]
    rows += [(5, [0.5] * 16, 1), (5, [0.5] * 16, 1), (None, [1.0] * 16, None)]
    return rows


def test_fit_matches_plain_comparison(spark, clustered):
    assert got(V.compress(frame(spark, clustered, SCHEMA))) == plain(clustered)


def test_other_sizes(spark, clustered):
    some = [(i, v and v[:10], label) for i, v, label in clustered[::7]]
    assert got(V.compress(frame(spark, some, SCHEMA), 3, 5, 2)) == plain(some, 3, 5, 2)
    ragged = [(1, [0.1, 0.2, 0.3], 1), (2, [], 1), (3, [1.0] * 9, 2), (4, [-0.5], None)]
    assert got(V.compress(frame(spark, ragged, SCHEMA))) == plain(ragged)


def test_few_rows_empty_tables_and_clashing_columns(spark):
    assert got(V.compress(frame(spark, [], SCHEMA))) == []
    assert got(V.compress(frame(spark, [(1, [], None), (2, [], 3)], SCHEMA))) == plain([(1, [], None), (2, [], 3)])
    one = [(7, [0.1] * 8, 1)]
    clash = frame(spark, [(7, [0.1] * 8, 1, 2, 3)], SCHEMA + ", row int, part int")
    assert got(V.compress(clash)) == plain(one)
    huge = V.compress(frame(spark, [(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1)], SCHEMA)).collect()
    assert [r["error"] for r in huge] == [0, 0]


def test_shortlists_lose_no_entry():
    rng = np.random.default_rng(2)
    for scale in (1, 30, 1000):
        pieces = rng.integers(-scale, scale, (64, 4))
        entries = rng.integers(-1000, 1000, (16, 4))
        listed = V.shortlist(pieces.min(0)[None], pieces.max(0)[None], entries)[0]
        best, _ = V.nearest(pieces, entries)
        assert listed[best].all()
    close = rng.integers(0, 3, (64, 4))
    assert V.shortlist(close.min(0)[None], close.max(0)[None], rng.integers(-1000, 1000, (16, 4))).sum() < 4


@pytest.mark.parametrize("dim,bits", [(2, 4), (3, 3), (8, 1)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dim, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), -1).reshape(-1, dim)
    place = places(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    walked = cells[np.argsort(place)]
    assert (np.abs(np.diff(walked, axis=0)).sum(1) == 1).all()


def test_query_against_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    result = QUERIES["op12_vector_codes"](spark, SF)
    expected = duck.execute(ORACLES["op12_vector_codes"])
    assert result.columns == [c[0] for c in expected.description]
    assert sorted(map(tuple, result.collect())) == sorted(expected.fetchall())
    assert result.where(F.col("error") < 0).count() == 0
