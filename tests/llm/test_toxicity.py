import zlib

import numpy as np
import pytest

from gatehouse.llm import toxicity_cnn as T
from tests.llm.frames import LONG, collect, docs

BAD = ["vile", "rotten", "nasty"]


def corpus(n=400, seed=1):
    r = np.random.default_rng(seed)
    words = ["w%d" % i for i in range(300)] + "the and of in that".split() * 20
    out = []
    for i in range(n):
        ws = list(r.choice(words, int(r.integers(10, 80))))
        y = int(i % 4 == 0)
        if y:
            for _ in range(int(r.integers(1, 4))):
                ws.insert(int(r.integers(len(ws))), str(r.choice(BAD)))
        out.append((i, " ".join(ws), y))
    return out


@pytest.fixture(scope="module")
def model():
    rows = [r for r in corpus() if zlib.crc32(str(r[0]).encode()) % 5]
    return T.train_on([T.words_of(t.encode()) for _, t, _ in rows], np.array([y for *_, y in rows]))


def test_held_out_accuracy(model):
    scorer = T.Scorer(model)
    held = [r for r in corpus() if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    fresh = corpus(200, 9)
    for part in (held, fresh):
        right = sum((scorer(t.encode())[0] >= 0.5) == bool(y) for _, t, y in part)
        assert right / len(part) >= 0.95


def test_batches_chunks_and_single_texts_agree(model, monkeypatch):
    texts = [t.encode() for _, t, _ in corpus(60, 3)] + [b"", b" ,. ", b"vile", "é vile!".encode()]
    scorer = T.Scorer(model)
    alone = [scorer(t) for t in texts]
    assert np.allclose([p for p, _ in scorer.many(texts)], [p for p, _ in alone], atol=1e-6)
    monkeypatch.setattr(T, "CHUNK", 40)
    chunked = [scorer(t) for t in texts]
    assert np.allclose([p for p, _ in chunked], [p for p, _ in alone], atol=1e-6)
    assert [g for _, g in chunked] == [g for _, g in alone]


def test_calibration_moves_the_cut_to_one_half(model):
    for lang, cut in enumerate(model.cut):
        assert abs(model.calibrated(float(cut), lang) - 0.5) < 1e-9
        assert model.calibrated(0.0, lang) == 0 and abs(model.calibrated(1.0, lang) - 1) < 1e-9


def test_best_cut():
    assert T.best_cut(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1, 1, 0, 0])) == 0.5
    assert T.best_cut(np.array([0.9, 0.9]), np.array([1, 1])) == 0.5
    assert 0.2 < T.best_cut(np.array([0.3, 0.3, 0.2, 0.2]), np.array([1, 1, 0, 0])) < 0.3


def test_the_cut_does_not_depend_on_the_share_in_the_sample():
    r = np.random.default_rng(5)
    y = (np.arange(20_000) % 10 == 0).astype(int)
    p = 1 / (1 + np.exp(-r.normal(np.where(y == 1, 1.0, -1.0), 1.0)))
    whole = T.best_cut(p, y)
    few = np.concatenate([np.flatnonzero(y == 1), np.flatnonzero(y == 0)[:2000]])       # 50:50
    assert abs(T.best_cut(p[few], y[few], np.where(y[few] == 1, 1.0, 9.0)) - whole) < 0.06
    assert T.best_cut(p[few], y[few]) < whole - 0.15


def test_words_are_cut_in_each_class():
    sizes = [(0, o, 10) for o in range(100)] + [(1, o, 10) for o in range(0, 100, 10)]
    assert T.words_cut(sizes, 1100) == {0: 99, 1: 90}
    assert T.words_cut(sizes, 600) == {0: 49, 1: 90}
    assert T.words_cut([], 600) == {}


def test_frames(spark):
    rows = [(i, t) for i, t, _ in corpus(200)] + [(500, None), (501, ""), (None, "vile"), (3, corpus(200)[3][1]), (502, LONG + " vile")]
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in corpus(200)] + [(None, 1, 1), (7, 0, None), (9999, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    df = docs(spark, rows)
    m = T.train(df, labels)
    out = T.score(df, m)
    assert out.columns == [*df.columns, "score", "language"]
    assert T.score(out, m).columns == out.columns
    got = {(r.doc_id, r.text): r.score for r in out.collect()}
    assert out.count() == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert got[500, None] == got[501, ""] < 0.5 <= got[502, LONG + " vile"]
    again = {(r.doc_id, r.text): r.score for r in T.score(df, T.train(df, labels)).collect()}
    assert again == got


def test_empty_and_one_sided_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert collect(T.score(docs(spark, []), T.train(docs(spark, []), none))) == []
    one = spark.createDataFrame([(1, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert T.score(docs(spark, [(1, "a"), (2, None)]), T.train(docs(spark, [(1, "a")]), one)).where("score >= 0.5").count() == 0


def test_runs_without_blanks_are_read_to_their_end():
    run = "これはとても長い文章でどこにも空白がありません" * 40
    words = T.words_of(run.encode())
    assert len(words) > 100 and max(map(len, words)) <= T.REACH
    assert "".join(w.decode()[:2] for w in words[:-1]) + words[-1].decode() == run             # all of it, in order
    assert T.words_of(b"short words, only; " + b"x" * T.REACH) == [b"short", b"words", b"only", b"x" * T.REACH]
    long = T.words_of(b"a" * (T.REACH + 1) + b" b")
    assert long[-1] == b"b" and set(long[:-1]) <= {b"aaaa", b"aaa"}
    other = run[:-30] + "ひどい言葉" + run[-25:]
    assert T.words_of(other.encode()) != words                       # a change near the end is seen


def test_every_labelled_row_counts(spark):
    """A word met only in rows behind the 2,000 of a class that were once sampled, and a row of many words, are learned from."""
    from pyspark.sql import functions as F
    n = 3200
    ids = spark.range(n).withColumn("order", F.xxhash64(F.lit("sample"), "id")).where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
    late = {r.id for r in ids.where("id % 20 != 0").orderBy("order").offset(2000).collect()}
    assert len(late) > 50
    rows = [(i, "plain words here " + ("tardy" if i in late else "vile" if i % 20 == 0 else "fine")) for i in range(n)]
    rows[20] = (20, "much " * 60_000 + "vile")
    labels = spark.createDataFrame([(i, 1, int(i % 20 == 0)) for i in range(n)], "doc_id bigint, quality int, toxic int")
    got = T.training_rows(docs(spark, rows), labels, "toxic")
    assert got.count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(n))
    m = T.train(docs(spark, rows), labels)
    for t, at in enumerate(T.rows_of(T.features([b"tardy"]))):
        assert m.emb[t][at].any(axis=1).all()
    p = {w: T.Scorer(m)(b"plain words here " + w)[0] for w in (b"vile", b"tardy", b"fine")}
    assert p[b"vile"] >= 0.5 > max(p[b"tardy"], p[b"fine"])


def test_units_learn_together_whatever_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(T, "UNIT", 60)
    rows = [(i, t) for i, t, _ in corpus(800)]
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in corpus(800)], "doc_id bigint, quality int, toxic int")
    one = T.train(docs(spark, rows).repartition(7), labels.repartition(3))
    two = T.train(docs(spark, rows[::-1]).coalesce(1), labels)
    assert all((a == b).all() for a, b in zip([*one.emb, *one.layers, one.cut], [*two.emb, *two.layers, two.cut]))
    scorer = T.Scorer(one)
    assert sum((scorer(t.encode())[0] >= 0.5) == bool(y) for _, t, y in corpus(200, 9)) >= 190
    written = T.dealt(T.training_rows(docs(spark, rows), labels, "toxic"), 4)
    *_, texts = T.counted_scores(written, one)
    assert texts.sum() == written.count()


def test_a_long_text_is_learned_from_in_parts(model, monkeypatch):
    v = T.Vocabulary()
    v.add([b""])
    ids = v.add(T.words_of(" ".join(t for _, t, _ in corpus(20, 4)).encode()))
    top, words = model.peaks(ids, v.rows)
    for wide in (1, 5, len(ids) - 1):
        monkeypatch.setattr(T, "WIDE", wide)
        again, same = model.peaks(ids, v.rows)
        assert np.allclose(again, top, atol=1e-5)
        x = model.responses(model.vectors(v.rows[:, ids])).max(axis=0, initial=0)
        assert np.allclose(x, top, atol=1e-5) and (same[top == 0] == 0).all()
