"""Exact top-k search: tiled matrix products and a tree of merged lists.

Components become the integers floor(1024 * x); the score is their inner
product. A tile multiplies a block of queries with a shard, ``STRIP`` queries at
a time, selects each query's k best by partial selection, and only those leave
the task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehouse.llm.tiles import merge_tree, tile_lists, usable

SCALE = 1024
SHARD_ROWS = 4096
BLOCK_ROWS = 4096
STRIP = 256
MAX_LONG = (1 << 63) - 1


def quantised(v: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), exact: as doubles while they hold integers, else as Python integers."""
    with np.errstate(over="ignore"):
        f = np.floor(v * scale)
    if np.isfinite(f).all():
        return f
    return np.array([[int(x) * scale if abs(x) > 2.0 ** 60 else int(np.floor(x * scale)) for x in row] for row in v], object)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products, negated; beyond a long they stop at its ends."""
    if q.dtype != object and x.dtype != object:
        most = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * max(1, q.shape[1])
        if most < 2.0 ** 53:                    # every partial sum is an exact double
            return (-(q @ x.T)).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    q, x = (whole(m) if m.size else m.astype(object) for m in (q, x))
    s = -(q @ x.T)
    return np.array([[max(-MAX_LONG, min(MAX_LONG, int(c))) for c in row] for row in s], np.int64)


def top_lists(ids, x, qid, q, k: int, scale: int = SCALE):
    """For each query its k best (negated score, id) of the shard, ties to the smaller id."""
    x, q = quantised(x, scale), quantised(q, scale)
    out = []
    for at in range(0, len(qid), STRIP):
        neg = products(q[at:at + STRIP], x)
        for row, own in zip(neg, qid[at:at + STRIP]):
            take = np.flatnonzero(ids != own)
            if len(take) > k:                   # ties at the edge may be many: all of them stay for now
                part = row[take]
                take = take[part <= np.partition(part, k - 1)[k - 1]]
            take = take[np.lexsort((ids[take], row[take]))][:k]
            out.append([(int(row[i]), int(ids[i])) for i in take])
    return out


def exact_topk(df: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
               scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each query row.

    ``queries`` is a condition on ``id``. Rows without an id, and vectors that
    are null or hold null or non-finite components, take no part; vectors of
    different length are not compared. A query's own rows are those of its id.
    Ties go to the smaller id; repeated rows are ranked one by one, a
    repeated query once. An empty table gives an empty result.
    """

    def kernel(ids, x, qid, q, shard):
        return top_lists(ids, x, qid, q, k, scale)

    lists, shards = tile_lists(usable(df, vec_id, vector), queries, kernel, "bigint", SHARD_ROWS, BLOCK_ROWS)
    best = merge_tree(lists, shards, k)
    return best.select("query_id", "rank", "vec_id", (-F.col("neg")).alias("score"))
