"""Approximate nearest neighbours: a forest of random-projection trees.

Every row is indexed. Rows are dealt into shards; a shard holds ``TREES`` trees
over its rows, each split by the direction between two random rows at the
median, down to leaves of ``LEAF`` rows. A query walks all trees of a shard
through one priority queue: the branch that was not taken waits under the
largest margin by which its path was missed, and the smallest margin is
opened next, whatever tree it is in. The search ends when the leaves opened
hold ``SEARCH`` of the shard's rows, and ``LEAST`` rows at least; these candidates are scored exactly, in
double precision, and the shards' lists are merged.

Largest inner product becomes nearest neighbour by one more component that
gives all rows the same length; it is zero where they have it already.

On vectors without structure (the test table is close to a uniform sphere of
64 dimensions) half the rows must be looked at for a recall above 0.9; on
clustered vectors ``search`` can be far smaller.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehouse.llm.tiles import merge_tree, tile_lists, usable

TREES = 10
LEAF = 64
SEARCH = 0.65           # share of a shard's rows that a query looks at
LEAST = 1536            # rows of a shard that it looks at in any case
SHARD_ROWS = 8192
BLOCK_ROWS = 4096


class Forest:
    """Trees over ``x``; nodes are numbered through all trees."""

    def __init__(self, x: np.ndarray, trees: int, leaf: int, seed: int):
        self.rng = np.random.default_rng(seed)
        self.x, self.leaf = x, leaf
        self.normal: list[np.ndarray] = []
        self.at: list[float] = []
        self.kids: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        self.roots = [self.grow(np.arange(len(x))) for _ in range(trees)]
        self.normals = np.array(self.normal).reshape(len(self.normal), x.shape[1])
        self.offsets = np.array(self.at)

    def grow(self, rows: np.ndarray) -> int:
        top = self.node(rows)
        todo = [top] if len(rows) > self.leaf else []
        while todo:
            n = todo.pop()
            rows, self.rows[n] = self.rows[n], None
            self.kids[n] = tuple(self.node(part) for part in self.cut(n, rows))
            todo += [k for k in self.kids[n] if len(self.rows[k]) > self.leaf]
        return top

    def node(self, rows: np.ndarray) -> int:
        self.normal.append(np.zeros(self.x.shape[1]))
        self.at.append(0.0)
        self.kids.append(None)
        self.rows.append(rows)
        return len(self.rows) - 1

    def cut(self, n: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(3):
            a, b = self.x[self.rng.choice(rows, 2, replace=False)]
            w = a - b
            size = np.linalg.norm(w)
            if size == 0:
                continue
            p = self.x[rows] @ (w / size)
            t = float(np.median(p))
            left = p <= t
            if left.any() and not left.all():
                self.normal[n], self.at[n] = w / size, t
                return rows[left], rows[~left]
        half = self.rng.permutation(rows)       # equal rows: either side is as near
        return half[:len(rows) // 2], half[len(rows) // 2:]

    def candidates(self, margins: np.ndarray, want: int) -> np.ndarray:
        """Rows of the leaves opened for one query; ``margins``: its signed ones at all nodes."""
        kids, rows = self.kids, self.rows
        queue = [(0.0, r) for r in self.roots]
        seen = np.zeros(len(self.x), bool)
        found = 0
        while queue and found < want:
            missed, n = heapq.heappop(queue)
            while kids[n] is not None:
                m = margins[n]
                left, right = kids[n]
                n, far = (right, left) if m > 0 else (left, right)
                heapq.heappush(queue, (max(missed, abs(m)), far))
            mine = rows[n]
            found += len(mine) - int(np.count_nonzero(seen[mine]))
            seen[mine] = True
        return np.flatnonzero(seen)


def top_lists(ids, x, qid, q, k: int, trees: int, leaf: int, search: float, seed: int):
    """For each query its k nearest (negated score, id) among the candidates of the shard."""
    square = (x * x).sum(axis=1)
    lift = np.sqrt(np.maximum(square.max() - square, 0))
    forest = Forest(np.column_stack([x, lift]), trees, leaf, seed)
    # candidates are first compared in single precision, with room for its rounding
    small = max(np.abs(x).max(), np.abs(q).max(initial=0)) < 1e15
    rough_x = x.astype(np.float32) if small else x
    longest = float(np.sqrt(square.max()))
    want = max(k + 1, LEAST, int(np.ceil(search * len(x))))
    out = []
    for at in range(0, len(qid), 256):
        part = np.column_stack([q[at:at + 256], np.zeros(len(q[at:at + 256]))])
        margins = part @ forest.normals.T - forest.offsets
        for own, v, m in zip(qid[at:at + 256], q[at:at + 256], margins):
            c = forest.candidates(m.tolist(), want)
            c = c[ids[c] != own]
            if len(c) > k:
                rough = rough_x[c] @ v.astype(rough_x.dtype)
                edge = np.partition(rough, len(c) - k)[len(c) - k]
                c = c[rough >= edge - 1e-4 * longest * float(np.sqrt(v @ v))]
            neg = -(x[c] * v).sum(axis=1)
            best = np.lexsort((ids[c], neg))[:k]
            out.append([(float(neg[i]), int(ids[c[i]])) for i in best])
    return out


def nearest(df: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, leaf: int = LEAF, search: float = SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k nearest rows found.

    ``queries`` is a condition on ``id``. Rows without an id, and vectors that
    are null, zero, or hold null or non-finite components, take no part;
    vectors of different length are not compared. A query's own rows are those
    of its id. Ties go to the smaller id; repeated rows are ranked one by one,
    a repeated query once. An empty table gives an empty result. Trees are
    drawn from fixed seeds, so reruns agree.
    """

    def kernel(ids, x, qid, q, shard):
        return top_lists(ids, x, qid, q, k, trees, leaf, search, seed=shard)

    lists, shards = tile_lists(usable(df, vec_id, vector, zero=False), queries, kernel, "double", SHARD_ROWS, BLOCK_ROWS)
    best = merge_tree(lists, shards, k)
    return best.select("query_id", "rank", "vec_id", (-F.col("neg")).alias("score"))
