"""Approximate nearest neighbours: one HNSW graph per shard, shard results merged.

Equal vectors become one node that keeps its k + 1 smallest ids, so that a vector which a
third of all rows share is one point of one graph; the ids are ranked in salted groups first.
Distinct vectors are dealt by their hash to shards of about `shard_size` nodes. Each shard's
graph (`hnsw.Graph`, flat arrays) is one row of the index. Queries come in blocks; every block
meets every shard, each pair in a task of bounded size, and the shard results, rescored with
exact distances in double precision, are merged per query.

Defined results: a vector that is null, empty, zero or holds null or non-finite components
takes no part, nor does a row with a null id. Rows with the query's own id are no candidates.
An id that occurs with several vectors is searched by the smallest of them. Only vectors of
equal dimension are compared. Ties go to the smaller id; with fewer than k candidates all
found are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.llm.common import checkpointed
from tracemill.llm.hnsw import Graph

SHARD_SIZE = 4096
QUERY_BLOCK = 512
SALTS = 64


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """(vector, ids): each vector of `vectors` (id, vector) with its k + 1 smallest ids."""
    salted = vectors.distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    few = Window.partitionBy("vector", "salt").orderBy("id")
    few_all = Window.partitionBy("vector").orderBy("id")
    for window in (few, few_all):
        salted = salted.withColumn("n", F.row_number().over(window)).where(F.col("n") <= k + 1).drop("n")
    return salted.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def build_index(vectors: DataFrame, k: int, shard_size: int = SHARD_SIZE) -> DataFrame:
    """(dim, shard, graph): one row per shard over `vectors` (id long, vector array<double>)."""
    nodes = checkpointed(distinct_vectors(vectors, k).withColumn("dim", F.size("vector")))
    shards = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard_size).cast("long").alias("shards"))
    placed = nodes.join(F.broadcast(shards) if shards.count() <= 1000 else shards, "dim").select(
        "dim", F.pmod(F.xxhash64("vector"), F.col("shards")).alias("shard"), "vector", "ids"
    )

    def build(table: pa.Table) -> pa.Table:
        points = _matrix(table["vector"])
        ids = table["ids"].combine_chunks()
        members = [np.array(x, np.int64) for x in ids.to_pylist()]
        order = np.argsort([m[0] for m in members], kind="stable")
        points, members = points[order], [members[i] for i in order]
        draws = 1 - np.random.default_rng(len(points)).random(len(points))
        graph = Graph.build(points, draws)
        offsets = np.concatenate([[0], np.cumsum([len(m) for m in members])]).astype(np.int64)
        return pa.table({
            "dim": table["dim"].slice(0, 1), "shard": table["shard"].slice(0, 1), "graph": pa.array([graph.dump()], pa.binary()),
            "points": pa.array([points.tobytes()], pa.binary()),
            "members": pa.array([np.concatenate(members).tobytes()], pa.binary()), "offsets": pa.array([offsets.tobytes()], pa.binary()),
        })

    return placed.groupBy("dim", "shard").applyInArrow(
        build, "dim int, shard long, graph binary, points binary, members binary, offsets binary"
    )


def search_index(index: DataFrame, queries: DataFrame, k: int, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of `queries` (id, vector) among all vectors of `index`."""
    index = checkpointed(index)
    blocks = max(1, math.ceil(queries.count() / block))
    dealt = queries.withColumn("dim", F.size("vector")).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    shards = index.select(F.col("dim").alias("of_dim"), F.col("shard").alias("of_shard"))
    asked = dealt.join(shards, dealt.dim == shards.of_dim).select("of_dim", "of_shard", F.col("block").alias("of_block"), "id", "vector")
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))

    def search(shard: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(shard) or not len(asked):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        graph = Graph.load(shard["graph"][0].as_py())
        points = np.frombuffer(shard["points"][0].as_py(), np.float64).reshape(len(graph.points), -1)
        members, offsets = (np.frombuffer(shard[name][0].as_py(), np.int64) for name in ("members", "offsets"))
        vectors, ids = _matrix(asked["vector"]), asked["id"].to_numpy()
        found = graph.search(vectors, min(2 * k, len(points)))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for row, nodes in enumerate(found):
            nodes = nodes[nodes >= 0]
            score = np.sqrt(((points[nodes] - vectors[row]) ** 2).sum(1))
            sizes = offsets[nodes + 1] - offsets[nodes]
            vec = np.concatenate([members[offsets[n] : offsets[n + 1]] for n in nodes])
            far = np.repeat(score, sizes)
            own = vec != ids[row]
            vec, far = vec[own], far[own]
            best = np.lexsort((vec, far))[:k]
            out.append((np.full(len(best), ids[row]), vec[best], far[best]))
        query, vec, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.float64())})

    pairs = held.groupBy("dim", "shard", "block").cogroup(asked.groupBy("of_dim", "of_shard", "of_block"))
    found = pairs.applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    # An id with several vectors is found once, at its nearest one.
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
            shard_size: int = SHARD_SIZE) -> DataFrame:
    """The k nearest rows of `vectors` found for each row that meets `is_query`."""
    rows = vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asked")
    )
    queries = rows.where("asked").groupBy("id").agg(F.min("vector").alias("vector"))
    return search_index(build_index(rows.select("id", "vector"), k, shard_size), queries, k)
