"""A hierarchical navigable small-world graph over one shard's vectors, as flat arrays.

Layer 0 holds all nodes, each higher layer the nodes drawn for it. A layer's neighbours are
one (nodes x degree) array of positions in that layer, padded with -1. As a shard is small and
complete when its graph is built, candidates are the nearest nodes of the layer by blocked
matrix products; neighbours are picked from them by the usual rule that a candidate must be
nearer to the node than to any neighbour picked before, and links are made mutual. Search is
greedy from the top layer and keeps the `beam` best nodes on layer 0, for all queries at once.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np

BLOCK = 256


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :], 0)


def _nearest(distance: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k smallest, smallest first."""
    part = np.argpartition(distance, k - 1, axis=1)[:, :k] if k < distance.shape[1] else np.tile(np.arange(distance.shape[1]), (len(distance), 1))
    return np.take_along_axis(part, np.argsort(np.take_along_axis(distance, part, 1), axis=1, kind="stable"), 1)


def _picked(points: np.ndarray, near: np.ndarray, distance: np.ndarray, degree: int) -> np.ndarray:
    """Which of the candidates `near`, at `distance`, become neighbours."""
    vectors = points[near]
    norms = (vectors * vectors).sum(2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    picked = np.zeros(near.shape, bool)
    for j in range(near.shape[1]):
        blocked = (picked & (between[:, j, :] <= distance[:, j, None])).any(1)
        picked[:, j] = ~blocked & (picked.sum(1) < degree)
    return picked


def layer(points: np.ndarray, degree: int, width: int) -> np.ndarray:
    """Neighbours of each point: (points x 2 * degree) positions, -1 where there are fewer."""
    n = len(points)
    out = np.full((n, 2 * degree), -1, np.int32)
    if n < 2:
        return out
    width = min(width, n - 1)
    source, target, length = [], [], []
    for start in range(0, n, BLOCK):
        block = points[start : start + BLOCK]
        distance = squared(block, points)
        distance[np.arange(len(block)), np.arange(start, start + len(block))] = np.inf
        near = _nearest(distance, width)
        distance = np.take_along_axis(distance, near, 1)
        picked = _picked(points, near, distance, degree)
        source.append(start + np.nonzero(picked)[0])
        target.append(near[picked])
        length.append(distance[picked])
    source, target, length = map(np.concatenate, (source, target, length))
    source, target, length = np.concatenate([source, target]), np.concatenate([target, source]), np.tile(length, 2)
    order = np.lexsort((target, length, source))
    source, target = source[order], target[order]
    pair, first = np.unique(source.astype(np.int64) * n + target, return_index=True)
    keep = np.sort(first)
    source, target = source[keep], target[keep]
    place = np.arange(len(source)) - np.searchsorted(source, source)
    fits = place < 2 * degree
    out[source[fits], place[fits]] = target[fits]
    return out


@dataclass
class Graph:
    points: np.ndarray  # float32, one row per node
    nodes: list[np.ndarray]  # per layer, the nodes in it
    links: list[np.ndarray]  # per layer, positions in that layer

    @classmethod
    def build(cls, points: np.ndarray, draws: np.ndarray, degree: int = 16, width: int = 64) -> Graph:
        """`draws`: a uniform number in (0, 1] for each node, which decides its top layer."""
        points = np.ascontiguousarray(points, np.float32)
        level = np.minimum(np.floor(-np.log(draws) / np.log(degree)).astype(int), 8)
        nodes, links = [], []
        for k in range(level.max() + 1):
            mine = np.flatnonzero(level >= k)
            nodes.append(mine.astype(np.int32))
            links.append(layer(points[mine], degree, width))
        return cls(points, nodes, links)

    def search(self, queries: np.ndarray, k: int, beam: int = 96) -> np.ndarray:
        """The k nearest nodes found for each query, nearest first, -1 where there are fewer."""
        queries = np.ascontiguousarray(queries, np.float32)
        rows = np.arange(len(queries))
        at = np.zeros(len(queries), np.int64)  # a position in the current layer
        for depth in range(len(self.nodes) - 1, 0, -1):
            nodes, links = self.nodes[depth], self.links[depth]
            best = self._distance(queries, nodes[at])
            moving = rows
            while len(moving):
                near = links[at[moving]]
                distance = self._distances(queries[moving], np.where(near < 0, -1, nodes[near]))
                pick = distance.argmin(1)
                found = distance[np.arange(len(moving)), pick]
                better = found < best[moving]
                moving, pick, found, near = moving[better], pick[better], found[better], near[better]
                at[moving], best[moving] = near[np.arange(len(moving)), pick], found
            below = np.searchsorted(self.nodes[depth - 1], nodes[at])
            at = below
        return self._beam(queries, at, max(k, beam))[:, :k]

    def _distance(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return ((queries - self.points[nodes]) ** 2).sum(1)

    def _distances(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        difference = self.points[nodes] - queries[:, None, :]
        return np.where(nodes < 0, np.inf, np.einsum("qnd,qnd->qn", difference, difference))

    def _beam(self, queries: np.ndarray, at: np.ndarray, beam: int) -> np.ndarray:
        count, links = len(queries), self.links[0]
        found = np.full((count, beam), -1, np.int64)
        distance = np.full((count, beam), np.inf, np.float32)
        done = np.ones((count, beam), bool)
        seen = np.zeros((count, len(self.points) + 1), bool)  # the last column stands for -1
        seen[:, -1] = True
        rows = np.arange(count)
        found[:, 0], distance[:, 0], done[:, 0] = at, self._distance(queries, at), False
        seen[rows, at] = True
        while True:
            waiting = np.where(done, np.inf, distance)
            pick = waiting.argmin(1)
            live = np.flatnonzero(np.isfinite(waiting[rows, pick]))
            if not len(live):
                return found
            done[live, pick[live]] = True
            near = links[found[live, pick[live]]].astype(np.int64)
            new = ~seen[live[:, None], near]
            seen[live[:, None], near] = True
            near = np.where(new, near, -1)
            reached = self._distances(queries[live], near)
            ids = np.concatenate([found[live], near], 1)
            lengths = np.concatenate([distance[live], reached.astype(np.float32)], 1)
            flags = np.concatenate([done[live], near < 0], 1)
            order = np.argsort(lengths, axis=1, kind="stable")[:, :beam]
            found[live], distance[live], done[live] = (np.take_along_axis(x, order, 1) for x in (ids, lengths, flags))

    def dump(self) -> bytes:
        return pickle.dumps((self.points, self.nodes, self.links), protocol=5)

    @classmethod
    def load(cls, raw: bytes) -> Graph:
        return cls(*pickle.loads(raw))
