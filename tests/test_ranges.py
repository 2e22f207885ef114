"""Positions, totals and last values over ranges, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tracemill.operators.ranges import running
from tracemill.session import staged


@pytest.fixture
def uneven():
    """Half of all rows belong to one key, and most of those to one moment."""
    rng = random.Random(5)
    rows = [("hot", 7 if i % 5 else i, i, i % 13 if i % 3 else None) for i in range(3000)]
    rows += [(rng.choice(["a", "b", None]), rng.randrange(50), 3000 + i, i) for i in range(3000)]
    rng.shuffle(rows)
    return rows


def expected(rows):
    out, state = {}, {}
    for key, moment, seq, value in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        n, total, last = state.get(key, (0, 0, None))
        state[key] = n + 1, total + (value or 0), last if value is None else value
        out[seq] = state[key]
    return out


def test_running_columns(spark, uneven):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(uneven, "k string, moment long, seq long, value long").repartition(7)
        got = running(
            df, ["k"], ["moment", "seq"], staged,
            {"n": F.lit(1), "total": F.coalesce("value", F.lit(0))}, {"last": F.col("value")},
        )
        assert {r["seq"]: (r["n"], r["total"], r["last"]) for r in got.collect()} == expected(uneven)
        assert got.columns == ["k", "moment", "seq", "value", "n", "total", "last"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_key_and_no_rows(spark):
    df = spark.range(500).withColumn("at", F.col("id") % 3)
    got = running(df, [], ["at", "id"], staged, {"n": F.lit(1)}).orderBy("n").collect()
    assert [r["id"] for r in got] == sorted(range(500), key=lambda i: (i % 3, i))
    assert running(df.where("id < 0"), [], ["id"], staged, {"n": F.lit(1)}).count() == 0


def test_a_hot_key_is_spread_evenly(spark, uneven):
    from tracemill.operators.ranges import in_ranges

    df = spark.createDataFrame(uneven, "k string, moment long, seq long, value long")
    placed = in_ranges(df.repartition(7), ["k"], ["moment", "seq"], staged)
    sizes = sorted(r["count"] for r in placed.groupBy(F.shiftright("at", 33)).count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
