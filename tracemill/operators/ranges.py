"""Positions, running totals and last values over rows in order, whatever a key's share.

The rows are dealt to ranges of (keys, order), as even as Spark's sample makes them. A key that
holds a third of all rows is spread over a third of the ranges, also where its rows share one
moment, as long as the columns after it tell them apart. Only the first key of a range can begin
in an earlier one, so what ranges hand on is at most one row per range.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: `monotonically_increasing_id` counts rows below this bit and partitions above it.
ROW_BITS = 33

Stage = Callable[[DataFrame, str], DataFrame]


def unused(df: DataFrame, *names: str) -> list[str]:
    taken = {name.lower() for name in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def in_ranges(df: DataFrame, keys: Sequence, order: Sequence, stage: Stage, at: str = "at") -> DataFrame:
    """``df`` sorted over all partitions, with the row's place in ``at``.

    The table is written once through ``stage``: bounds and places are then the same for
    every reader, whatever is lost or run again. Their number follows the rows: one per
    shuffle partition, and small ones merged by adaptive execution.
    """
    placed = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    return stage(placed.withColumn(at, F.monotonically_increasing_id()), "ranges")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    stage: Stage,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
) -> DataFrame:
    """``df`` with running columns per key, the row itself included.

    ``sums`` are totals from the key's first row on, ``lasts`` the latest value that is not
    null. Rows that are equal in ``keys`` and ``order`` stand in any order.
    """
    sums, lasts = sums or {}, lasts or {}
    at, span = unused(df, "at", "span")
    named = [*[v.alias(k) for k, v in sums.items()], *[v.alias(k) for k, v in lasts.items()]]
    values = df.select(*df.columns, *named)
    rows = in_ranges(values, keys, order, stage, at).withColumn(span, F.shiftright(at, ROW_BITS))

    def latest(name: str) -> Column:
        return F.max(F.when(F.col(name).isNotNull(), F.struct(at, name)))[name]

    pieces = rows.groupBy(*keys, span).agg(
        *[F.sum(name).alias(name) for name in sums], *[latest(name).alias(name) for name in lasts]
    )
    earlier = Window.partitionBy(*keys).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(
        *keys, span, F.count("*").over(earlier).alias("pieces"),
        *[F.sum(name).over(earlier).alias(name) for name in sums],
        *[F.last(name, ignorenulls=True).over(earlier).alias(name) for name in lasts],
    ).where("pieces > 0").drop("pieces")
    inside = Window.partitionBy(*keys, span).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.withColumns(
        {name: F.sum(name).over(inside) for name in sums}
        | {name: F.last(name, ignorenulls=True).over(inside) for name in lasts}
    )
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, span]])
    # At most one row per range, so its size is bounded by the number of shuffle partitions.
    joined = ranked.alias("r").join(F.broadcast(carried).alias("c"), same, "left")
    return joined.select(
        *[F.col(f"r.{c}") for c in df.columns],
        *[(F.col(f"r.{n}") + F.coalesce(F.col(f"c.{n}"), F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(F.col(f"r.{n}"), F.col(f"c.{n}")).alias(n) for n in lasts],
    )
