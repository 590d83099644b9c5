import numpy as np

from gatehouse.llm import rule_quality as Q
from tests.llm.frames import LONG, collect, docs


def data(n=600, seed=1):
    r = np.random.default_rng(seed)
    x = r.random((n, len(Q.NAMES)))
    y = ((x[:, 3] > 0.4) & (x[:, 8] <= 0.8) | (x[:, 1] > 0.95)).astype(float)
    return x, y


def test_rules_find_a_conjunction():
    x, y = data()
    m = Q.fit(x, y)
    assert 0 < len(m.rules) < 150
    x2, y2 = data(2000, 7)
    assert ((m.logits(x2) > 0) == y2).mean() >= 0.95


def test_lasso_is_sparse_and_shrinks():
    x, y = data()
    weak, strong = Q.fit(x, y, 0.001), Q.fit(x, y, 0.05)
    assert len(strong.rules) < len(weak.rules)


def test_statistics_of_a_text():
    s = dict(zip(Q.NAMES, Q.text_statistics("Aa bb bb\nÉ#1.\nÉ#1.".encode())))
    assert s["chars"] == 18 and s["words"] == 5 and s["repeats"] == 2 / 5 and s["distinct_words"] == 3 / 5
    assert s["lines"] == 3 and s["distinct_lines"] == 2 / 3 and s["upper"] == 1 / 18 and s["digits"] == 2 / 18
    assert s["marks"] == 2 / 18 and s["stops"] == 2 / 5
    assert all(np.isfinite(Q.text_statistics(t)).all() for t in (b"", b" ", b"\n\n", b"a"))


def test_statistics_do_not_depend_on_chunks(monkeypatch):
    text = (" ".join(np.random.default_rng(2).choice("ab cd ef \n gh.".split(" "), 500))).encode()
    whole = Q.text_statistics(text)
    monkeypatch.setattr(Q, "CHUNK", 13)
    assert Q.text_statistics(text) == whole


def test_columns_score_like_numpy(spark):
    x, y = data(300)
    m = Q.fit(x, y)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{n} double" for n in Q.NAMES))
    got = [r[0] for r in df.select(m.logit()).collect()]
    assert np.allclose(got, m.logits(x))


def test_frames(spark):
    good = [(i, f"this is text number {i} with many different words in it, such as w{i * 7} and v{i * 3}.") for i in range(120)]
    junk = [(1000 + i, f"BUY BUY BUY ### {i} $$$ " * 9) for i in range(120)]
    rows = good + junk + [(5000, None), (5001, ""), (None, "x"), (0, good[0][1]), (5002, LONG)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk] + [(None, 1, 1), (3, None, 1)],
                                   "doc_id bigint, quality int, toxic int")
    df = docs(spark, rows)
    out = Q.score(df, Q.train(df, labels))
    assert out.columns == [*df.columns, "score"] and out.count() == len(rows)
    got = {(r.doc_id, r.text): r.score for r in out.collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[5000, None] == got[5001, ""]
    right = sum(got[r] >= 0.3 for r in good) + sum(got[r] < 0.3 for r in junk)
    assert right >= 0.97 * 240


def test_classes_keep_their_shares_when_the_sample_cuts_one(spark):
    r = np.random.default_rng(4)
    rows = [(i, " ".join(r.choice("aa bb cc dd ee.".split(), 30))) for i in range(800)]
    labels = spark.createDataFrame([(i, int(r.random() < 0.85), 0) for i in range(800)], "doc_id bigint, quality int, toxic int")
    df = docs(spark, rows)
    share = labels.agg({"quality": "avg"}).first()[0]
    for most in (1000, 100):            # no class is cut; class 1 is cut to the size of the other
        m = Q.train(df, labels, rows=most)
        assert abs(Q.score(df, m).agg({"score": "avg"}).first()[0] - share) < 0.08, most


def test_empty_and_one_sided(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert collect(Q.score(docs(spark, []), Q.train(docs(spark, []), none))) == []
    one = spark.createDataFrame([(1, 1, 1)], "doc_id bigint, quality int, toxic int")
    df = docs(spark, [(1, "a"), (2, None)])
    assert [r.score >= 0.5 for r in Q.score(df, Q.train(df, one)).collect()] == [True, True]
