import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from gatehouse.llm import damage, periodic_runs as R
from gatehouse.llm.queries import QUERIES
from tests.llm.frames import LONG, docs
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain_runs(w, length=24, exponent=3):
    """Every period by itself; of the runs on one stretch the one of the smallest period."""
    n, best = len(w), {}
    for q in range(n // exponent, 0, -1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(length, exponent * q):
                best[i, j + q - i] = q
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def plain_damage(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is None or n == 0:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def random_words(r):
    w = []
    for _ in range(r.randint(0, 5)):
        unit = [r.randrange(r.choice([1, 2, 3, 50])) for _ in range(r.randint(1, 9))]
        w += (unit * 12)[:r.randint(1, 70)] if r.random() < .7 else unit
    return w


def test_runs_of_random_words():
    r = random.Random(0)
    for _ in range(700):
        length, exponent = r.choice([(24, 3), (6, 3), (9, 3), (12, 4), (3, 3)])
        texts = [random_words(r) for _ in range(r.randint(1, 4))]
        ids = np.array([x for t in texts for x in t], np.int64)
        got = R.runs_of(ids, np.cumsum([len(t) for t in texts]), length, exponent)
        assert [got.get(i, []) for i in range(len(texts))] == [plain_runs(t, length, exponent) for t in texts]


def test_least_pair():
    assert R.least_pair(24, 3) == 16 and R.least_pair(3, 3) == 2
    with pytest.raises(ValueError):
        R.runs_of(np.zeros(9, np.int64), np.array([9]), 4, 2)


def test_long_texts_stay_fast():
    n = 100_000
    assert R.runs_of(np.zeros(n, np.int64), np.array([n])) == {0: [(0, n, 1)]}
    assert R.runs_of(np.tile(np.arange(n // 5), 5), np.array([n])) == {0: [(0, n, n // 5)]}
    lines = np.concatenate([np.r_[i, np.arange(20) + n] for i in range(n // 21)])       # one line over and over, never twice in a row
    assert R.runs_of(lines, np.array([len(lines)])) == {}


def test_operator_on_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "a b " * 20 + "c"), (5, "a b " * 20 + "c"), (None, "x " * 30),
            (6, "a\x1fb \x0b" * 30), (7, "no run here")]
    df = docs(spark, rows).withColumnsRenamed({"fp": "runs", "shard": "row", "size": "collapsed"})
    got = R.find_runs(df)
    assert set(got.columns) == {"doc_id", "lang", "source", "n_chars", "source_size", "row", "n_words", "runs", "collapsed"}
    out = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect())
    want = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = plain_runs(w) if d != 4 else [(0, len(w), 3)]
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((str(d), len(w), runs, " ".join(x for i, x in enumerate(w) if i not in drop)))
    assert out == sorted(want)
    assert R.find_runs(docs(spark, [])).count() == 0


def test_blocks_change_nothing(spark, monkeypatch):
    df = docs(spark, [(i, f"w{i} " + "p q r " * (i % 13)) for i in range(300)]).coalesce(1)
    one = sorted(map(tuple, R.find_runs(df, carry=["doc_id"]).collect()))
    monkeypatch.setattr(R, "BLOCK", 50)
    monkeypatch.setattr(R, "ROWS", 3)
    assert sorted(map(tuple, R.find_runs(df, carry=["doc_id"]).collect())) == one


def test_best_run_is_exact(spark):
    rows = [([(0, 30, 10), (40, 31, 10), (90, 62, 20)],), ([(5, 24, 8), (2, 24, 8)],), ([],)]
    df = spark.createDataFrame(rows, f"runs array<{R.RUN}>")
    best = [r[0] and tuple(r[0]) for r in df.select(R.best_run("runs")).collect()]
    assert best[0] == (40, 31, 10) and best[2] is None


def test_damage(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 37))) for i in range(400)] + [(None, "a b"), (30, None), (31, " \t ")]
    df = docs(spark, rows)
    got = df.select("doc_id", F.col("text").alias("before"), damage.periodic_text(F.col("doc_id"), F.col("text")).alias("t")).collect()
    for r in got:
        assert re.findall(r"[^\x20\x09-\x0D]+", r.t or "") == plain_damage(r.doc_id, r.before)


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op12_maximal_pair_runs"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        w = plain_damage(r.doc_id, r.text)
        runs = plain_runs(w)
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(x for i, x in enumerate(w) if i not in drop)
        g = got[r.doc_id]
        assert g.n_runs == len(runs)
        assert g.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert g.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        if runs:
            s, n, q = min(runs, key=lambda t: (-t[1] / t[2], t[0], t[2]))
            assert (g.start, g.length, g.period, g.exponent_milli) == (s, n, q, 1000 * n // q)
        else:
            assert (g.start, g.length, g.period, g.exponent_milli) == (None,) * 4
