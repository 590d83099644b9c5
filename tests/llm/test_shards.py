from collections import Counter, defaultdict

import hashlib
from pyspark.sql import functions as F

from gatehouse.llm import extendible as X
from tests.llm.frames import LONG, collect, docs


def run(df, key, limit):
    return collect(X.shards(df, key, F.octet_length("text"), limit).select("key", "bytes", "shard", "depth", "shard_bytes"))


def check(got, limit):
    total = Counter()
    for _, b, s, _, _ in got:
        total[s] += b
    for _, b, s, d, sb in got:
        assert sb == total[s] and d == len(s)
        assert total[s] <= limit or b == total[s]
    return total


def test_only_oversized_buckets_split(spark):
    rows = [(i, "x" * (i * 7 % 50)) for i in range(3000)]
    got = run(docs(spark, rows), "doc_id", 1500)
    total = check(got, 1500)
    assert len(got) == 3000
    held = defaultdict(int)
    for i, t in rows:
        bits = format(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), "060b")
        for d in range(30):
            held[bits[:d]] += len(t)
    for s in total:                     # the parent of every shard was over the limit
        assert s == "" or held[s[:-1]] > 1500
        assert held[s] == total[s]


def test_hot_key_and_equal_rows_are_split_too(spark):
    rows = [(i, "y" * 10, "hot") for i in range(400)] + [(5, "z" * 10, "same")] * 300
    check(run(docs(spark, rows), "source", 200), 200)


def test_awkward_rows(spark):
    rows = [(None, "a"), (1, None), (2, ""), (3, LONG), (3, LONG), (4, "b")]
    got = run(docs(spark, rows), "doc_id", 100)
    check(got, 100)
    assert Counter((k, b) for k, b, *_ in got) == Counter((i, len(t or "")) for i, t in rows)
    assert run(docs(spark, []), "doc_id", 100) == []
    assert {s for *_, s, _, _ in run(docs(spark, rows[:3]), "doc_id", 100)} == {""}
