"""A vantage-point tree over rows of vectors, searched by many queries at once."""

from __future__ import annotations

import numpy as np

LEAF = 64
#: Queries compared with a leaf at once.
QUERY_BLOCK = 256


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean, in double precision, (queries, points)."""
    out = np.empty((len(queries), len(points)))
    for at in range(0, len(queries), QUERY_BLOCK):
        gap = queries[at : at + QUERY_BLOCK, None, :] - points[None, :, :]
        out[at : at + QUERY_BLOCK] = np.sqrt((gap * gap).sum(axis=-1))
    return out


class VPTree:
    """Points in leaf order, and nodes (start, end, vantage row, split, children and their reach).

    A node splits its points at the median distance from its vantage point,
    which is its point farthest from the first; each half remembers the least
    and the largest distance in it.
    """

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: np.ndarray, reach: np.ndarray):
        self.points, self.order, self.nodes, self.reach = points, order, nodes, reach

    @classmethod
    def build(cls, points: np.ndarray) -> VPTree:
        points = np.asarray(points, dtype=np.float64)
        order = np.arange(len(points))
        nodes: list[list[int]] = []
        reach: list[list[float]] = []
        todo = [(0, len(points), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            me = len(nodes)
            nodes.append([start, end, -1, -1, -1])
            reach.append([0.0] * 4)
            if parent >= 0:
                nodes[parent][3 + side] = me
            if end - start <= LEAF:
                continue
            rows = order[start:end].copy()
            vantage = int(rows[distances(points[rows[:1]], points[rows])[0].argmax()])
            away = distances(points[vantage][None], points[rows])[0]
            ranked = np.argsort(away, kind="stable")
            if away[ranked[-1]] == 0:  # all alike
                continue
            order[start:end], away = rows[ranked], away[ranked]
            middle = (end - start) // 2
            nodes[me][2] = vantage
            reach[me] = [away[0], away[middle - 1], away[middle], away[-1]]
            todo += [(start, start + middle, me, 0), (start + middle, end, me, 1)]
        return cls(points, order, np.array(nodes, dtype=np.int64).reshape(-1, 5), np.array(reach).reshape(-1, 4))

    def search(self, queries: np.ndarray, names: np.ndarray, k: int, factor: float):
        """The k nearest (distance, then name) of each query: (names, distances), padded with inf.

        A half is skipped if its least possible distance, by the triangle
        inequality, times ``factor`` is beyond the k-th distance so far. At
        factor one no neighbour can be missed; larger factors skip more.
        """
        queries = np.asarray(queries, dtype=np.float64)
        best = np.full((len(queries), k), np.inf)
        found = np.full((len(queries), k), np.iinfo(np.int64).max)
        if len(self.points):
            self._visit(0, np.arange(len(queries)), queries, names, best, found, factor)
        return found, best

    def _visit(self, node, asked, queries, names, best, found, factor) -> None:
        start, end, vantage, inner, outer = self.nodes[node]
        if vantage < 0:
            rows = self.order[start:end]
            self._leaf(rows, asked, queries, names, best, found)
            return
        away = distances(queries[asked], self.points[vantage][None])[:, 0]
        low_in, high_in, low_out, high_out = self.reach[node]
        floor_in = np.maximum(np.maximum(away - high_in, low_in - away), 0)
        floor_out = np.maximum(np.maximum(away - high_out, low_out - away), 0)
        near = floor_in <= floor_out  # the likelier half first
        for child, floor, mine in ((inner, floor_in, near), (outer, floor_out, ~near),
                                   (outer, floor_out, near), (inner, floor_in, ~near)):
            # a hair of slack, for rounding
            open_ = mine & (floor * factor <= best[asked, -1] * (1 + 1e-12) + 1e-12)
            if open_.any():
                self._visit(child, asked[open_], queries, names, best, found, factor)

    def _leaf(self, rows, asked, queries, names, best, found) -> None:
        gaps = distances(queries[asked], self.points[rows])
        every = np.hstack([best[asked], gaps])
        called = np.hstack([found[asked], np.broadcast_to(names[rows], gaps.shape)])
        k = best.shape[1]
        pick = np.lexsort((called, every), axis=1)[:, :k]
        best[asked] = np.take_along_axis(every, pick, axis=1)
        found[asked] = np.take_along_axis(called, pick, axis=1)
