import math

import numpy as np
import pytest

from gatehouse.llm import exact_topk as E
from gatehouse.llm import rp_forest as R
from gatehouse.llm import tiles
from pyspark.sql import functions as F
from tests.llm.frames import collect

VECTORS = "vec_id bigint, embedding array<float>, label int, id string, shard string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 3) for i, v in rows], VECTORS)


def cases():
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=6).astype("f4").tolist()) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(40)]                      # ties
    rows += [(1000, None), (1001, [None] * 6), (1002, [math.nan] * 6), (1003, [math.inf] + [0.0] * 5), (None, [1.0] * 6),
             (1100, [0.0] * 6), (1200, [1.0, 2.0]), (1201, [2.0, -1.0]), (10, rows[10][1]), (0, rows[0][1])]
    return rows


def plain(rows, every, k, quantise, zero):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
          and (zero or any(v))]
    q = {(i, tuple(v)) for i, v in ok if i % every == 0}
    out = []
    for i, v in q:
        a = [math.floor(1024 * x) for x in v] if quantise else v
        s = sorted((-sum(x * y for x, y in zip(a, [math.floor(1024 * y) for y in w] if quantise else w)), j)
                   for j, w in ok if j != i and len(w) == len(v))[:k]
        out += [(i, n + 1, j, -x) for n, (x, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block_rows", [(4096, 4096), (40, 2), (3, 1)])
def test_exact_topk(spark, monkeypatch, shard_rows, block_rows):
    monkeypatch.setattr(E, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(E, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(tiles, "FAN", 4)
    got = sorted(collect(E.exact_topk(frame(spark, cases()), F.col("id") % 20 == 0, 10)))
    assert got == plain(cases(), 20, 10, True, True)


def test_integers_too_large_for_doubles(spark):
    big = 3.0e9
    rows = [(0, [big, 1.0]), (1, [big, -1.0]), (2, [big, 0.5]), (3, [-big, 0.5]), (4, [1e30, 0.0])]
    got = sorted(collect(E.exact_topk(frame(spark, rows), F.col("id") == 0, 10)))
    most = (1 << 63) - 1                        # scores beyond a long stop at its ends, then ties go by id
    clipped = sorted((-max(-most, min(most, s)), v) for _, _, v, s in plain(rows, 100, 10, True, True))
    assert got == [(0, n + 1, v, -s) for n, (s, v) in enumerate(clipped)]


def test_nearest_is_exact_on_few_rows(spark):
    got = sorted(collect(R.nearest(frame(spark, cases()), F.col("id") % 20 == 0, 20)))
    want = plain(cases(), 20, 20, False, False)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want))


def test_forest_recall():
    r = np.random.default_rng(2)
    x = r.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(3000)
    tops = R.top_lists(ids, x, ids[::60], x[::60], 20, R.TREES, R.LEAF, R.SEARCH, 1)
    hit = 0
    for q, top in zip(ids[::60], tops):
        g = x @ x[q]
        g[q] = -9
        hit += len(set(np.argsort(-g)[:20]) & {i for _, i in top})
    assert hit / (50 * 20) >= 0.9


def test_forest_holds_every_row_also_with_many_copies():
    x = np.concatenate([np.ones((500, 4)), np.random.default_rng(3).normal(size=(300, 4))])
    f = R.Forest(x, 3, 16, 1)
    leaves = [r for r in f.rows if r is not None]
    assert sorted(np.concatenate(leaves).tolist()) == sorted(list(range(800)) * 3)
    assert max(map(len, leaves)) <= 16


def test_empty(spark):
    for rows in ([], [(100, None)], [(100, [1.0])]):
        assert collect(E.exact_topk(frame(spark, rows), F.col("id") % 100 == 0)) == []
        assert collect(R.nearest(frame(spark, rows), F.col("id") % 20 == 0)) == []
