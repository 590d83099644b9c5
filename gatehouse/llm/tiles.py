"""Queries against shards: what the two vector searches share.

Rows are dealt into shards of about ``shard_rows`` and queries into blocks of
about ``block_rows``, both by a hash of the id; every (shard, block) pair is one
tile, and one task holds one tile at a time. The sizes are bounds on memory,
not on the data: more rows make more tiles. A tile returns its best k for each
query, and the lists are merged in a tree of fan-in ``FAN``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehouse.llm.common import written

FAN = 8


def usable(df: DataFrame, vec_id: str, vector: str, zero: bool = True) -> DataFrame:
    """(id, v) of the rows that take part: an id, and finite components only.

    ``zero``: whether vectors whose components are all zero take part.
    """
    v = F.col(vector).cast("array<double>")
    ok = F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if not zero:
        ok = ok & F.exists("v", lambda x: x != 0)
    return df.select(F.col(vec_id).cast("bigint").alias("id"), v.alias("v")).where(ok)


def tile_lists(rows: DataFrame, queries: Column, kernel: Callable, kind: str, shard_rows: int,
               block_rows: int) -> tuple[DataFrame, int]:
    """(query_id, qh, shard, top) of every tile, and the number of shards.

    ``kernel(ids, vectors, query_ids, query_vectors, shard)`` yields for each
    query a list of (negated score, id), best first; it sees rows of one
    dimension only. ``kind`` is the score's type. ``qh`` tells queries of the same id apart.
    """
    import pyarrow as pa
    n, nq = rows.agg(F.count("*"), F.count(F.when(queries, 1))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-nq // block_rows))
    dim = F.size("v").alias("dim")
    cand = rows.select("id", "v", dim, F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    q = (rows.where(queries).distinct()
         .select("id", "v", dim, F.xxhash64("v").alias("qh"),
                 F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                 F.pmod(F.xxhash64(F.lit("query"), "id"), F.lit(blocks)).cast("int").alias("block")))
    keys = ["shard", "block", "dim"]
    top_t = pa.list_(pa.struct([("neg", pa.float64() if kind == "double" else pa.int64()), ("id", pa.int64())]))

    def tile(left, right):
        import numpy as np

        def matrix(table):
            col = table.column("v").combine_chunks()
            return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1) if len(col) else np.zeros((0, 0))

        names = ["query_id", "qh", "shard", "top"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.int32()),
                             pa.array([], top_t)], names=names)
        left = left.sort_by("id")
        shard = left.column("shard")[0].as_py()
        qid = right.column("id").to_numpy()
        tops = kernel(left.column("id").to_numpy(), matrix(left), qid, matrix(right), shard)
        return pa.table([pa.array(qid, pa.int64()), right.column("qh").combine_chunks(),
                         pa.array([shard] * len(qid), pa.int32()),
                         pa.array([[{"neg": s, "id": i} for s, i in t] for t in tops], top_t)], names=names)

    lists = cand.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(
        tile, f"query_id bigint, qh bigint, shard int, top array<struct<neg:{kind},id:bigint>>")
    return written(lists, "tiles"), shards


def merge_tree(lists: DataFrame, shards: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, neg): the best k of each query, from its tiles' lists."""
    node = F.col("shard")
    while True:
        shards = -(-shards // FAN)
        lists = (lists.groupBy("query_id", "qh", F.floor(node / FAN).cast("int").alias("shard"))
                 .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top")))
        if shards == 1:
            break
    best = lists.select("query_id", F.posexplode("top").alias("pos", "hit"))
    return best.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"),
                       F.col("hit.neg").alias("neg"))
