import random
import re
from collections import Counter

import pytest

from gatehouse.llm import entropy_mix as M
from tests.llm.frames import LONG, collect, docs


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, cap = 1.5 * sum(sizes.values()), {s: 2.0 * sizes[s] for s in sizes}
    target, done = {s: total * weight[s] / sum(weight.values()) for s in sizes}, set()
    while any(target[s] > cap[s] + 1e-9 for s in sizes if s not in done):
        done |= {s for s in sizes if target[s] >= cap[s]}
        rest, w = total - sum(cap[s] for s in done), sum(weight[s] for s in sizes if s not in done)
        target = {s: cap[s] if s in done else rest * weight[s] / w for s in sizes}
    return target


@pytest.fixture(scope="module")
def rows():
    out = [(i, "w " * (1 + i * 37 % 90), ["b", "a", "z", None, "é", "B", "c"][i * i % 7]) for i in range(400)]
    out += [(1000, None, "a"), (1001, "", "a"), (1002, " \t\n", None), (1003, LONG, "a"), (None, "no id here", "b"),
            (7, out[7][1], out[7][2]), (7, out[7][1], out[7][2]), (2000, "", "empty source"), (2001, "x\x0by\xa0z", "b")]
    return out


def test_mix_plan(spark, rows):
    got = collect(M.mix_plan(docs(spark, rows)).select("doc_id", "size", "source_size", "target", "copies", "taken"))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += words(t)
    target = plain_targets(dict(sizes))
    assert sorted((r[0], r[1]) for r in got if r[0] is not None) == sorted((i, words(t)) for i, t, _ in rows if i is not None)
    of = {i: s for i, _, s in rows}
    taken = Counter()
    for i, size, source_size, t, copies, took in got:
        s = of[i]
        assert source_size == sizes[s] and abs(t - target[s]) < 1e-6 * max(1, t)
        assert took == copies * size and 0 <= took <= 2 * size
        taken[s] += took
    for s in sizes:
        assert taken[s] <= target[s] + 1e-6
        if s != "a":            # the source of the very long text is as near as its other texts allow
            assert taken[s] >= 0.97 * target[s] - 3, s
    assert sorted(got, key=str) == sorted(collect(M.mix_plan(docs(spark, rows)).select(
        "doc_id", "size", "source_size", "target", "copies", "taken")), key=str)


def test_rates_are_exponential_tilts(spark):
    rows = [("a", s, n) for s, n in ((1, 50), (10, 40), (100, 10), (400, 2))]
    counts = spark.createDataFrame(rows, "source string, size bigint, n bigint")
    total = sum(s * n for _, s, n in rows)
    import math
    for share in (0.05, 0.6, 1.0, 1.4, 1.95):
        targets = spark.createDataFrame([("a", total, total * share)], "source string, source_size bigint, target double")
        r = M.tilts(counts, targets).first()
        got = sum(n * s * min(2.0, math.exp(min(700, r.lam * s / r.mean))) for _, s, n in rows)
        assert abs(got - total * share) <= max(0.02, 1e-8 * total), share


def test_mix_repeats_rows(spark, rows):
    df = docs(spark, rows)
    plan = Counter()
    for i, c in collect(M.mix_plan(df).select("doc_id", "copies")):
        plan[i] += c
    out = M.mix(df)
    assert out.columns == df.columns
    assert Counter(r[0] for r in collect(out.select("doc_id"))) == +plan


@pytest.mark.parametrize("few", [0, M.FEW])     # digit search only; few documents one by one
def test_a_long_document_does_not_end_the_rounding(spark, monkeypatch, few):
    monkeypatch.setattr(M, "FEW", few)
    r = random.Random(4)
    rows = []
    for s, long in (("a", 30_000), ("b", 9_000), ("c", 60_000)):
        sizes = [int(r.lognormvariate(5, 1)) + 1 for _ in range(150)] + [long]
        rows += [(len(rows) + k, "w " * n, s) for k, n in enumerate(sizes)]
    of = {i: s for i, _, s in rows}
    for share in (0.6, 1.0):
        got = [(of[i], size, copies, t) for i, size, copies, t in collect(
            M.mix_plan(docs(spark, rows), share=share).select("doc_id", "size", "copies", "target"))]
        for s in "abc":
            target = next(t for o, _, _, t in got if o == s)
            left = target - sum(size * copies for o, size, copies, _ in got if o == s)
            spare = [size for o, size, copies, _ in got if o == s and copies < 2]
            assert left > -1e-6 * target and all(size > left for size in spare), (share, s, left)
            assert left <= 0.03 * target, (share, s, left)


def test_first_copies_are_taken_in_order_and_skip_what_does_not_fit(spark, monkeypatch):
    r = random.Random(5)
    free = [(i, i, s, r.choice((1, 3, 10, 40, 200)), r.uniform(-1, 1)) for i in range(300) for s in (r.choice(("x", "y", None)),)]
    slots = 1 << (M.DIGIT * M.LEVELS)
    df = spark.createDataFrame([(*f, int((f[4] + 1) * slots / 2)) for f in free],
                               "rid bigint, doc_id bigint, source string, size bigint, place double, slot bigint")
    room = {"x": 731.5, "y": 250.0, None: 90.25}
    want, left = [], dict(room)
    for i, _, s, size, _ in sorted(free, key=lambda f: f[4]):
        if size <= left[s]:
            want.append(i)
            left[s] -= size
    for few in (0, M.FEW):
        monkeypatch.setattr(M, "FEW", few)
        picks, after = M.fill(df, spark.createDataFrame(list(room.items()), "s string, left double"))
        assert sorted(i for p in picks for i, in collect(p)) == sorted(want)
        assert dict(collect(after)) == left


def test_empty_tables(spark):
    assert collect(M.mix_plan(docs(spark, []))) == [] and collect(M.mix(docs(spark, []))) == []
    only = docs(spark, [(1, None, None), (2, "", None)])
    assert sorted(collect(M.mix_plan(only).select("doc_id", "target", "taken"))) == [(1, 0.0, 0), (2, 0.0, 0)]
    assert collect(M.mix(only)) == []


def best_sum(sizes, target):
    """Largest sum of 0 to 2 copies of each size within the target."""
    sums = {0}
    for n in sizes:
        sums |= {s + k * n for s in sums for k in (1, 2)}
    return max(s for s in sums if s <= target + 1e-7)


def test_small_sources_end_at_the_best_reachable_sum(spark):
    r = random.Random(6)
    rows, of = [], {}
    for s in ["src%02d" % k for k in range(24)]:
        sizes = [2, 39, 59, 97, 220, 977] if s == "src01" else [int(r.lognormvariate(4, 1.3)) + 1 for _ in range(r.randint(1, 12))]
        of[s] = sizes
        rows += [(len(rows) + k, "w " * n, s) for k, n in enumerate(sizes)]
    name = {i: s for i, _, s in rows}
    got = collect(M.mix_plan(docs(spark, rows)).select("doc_id", "size", "copies", "target"))
    for s, sizes in of.items():
        mine = [g for g in got if name[g[0]] == s]
        assert all(0 <= g[2] <= 2 for g in mine)
        assert sum(g[1] * g[2] for g in mine) == best_sum(sizes, mine[0][3]), s


def test_mix_keeps_clashing_columns_and_equal_rows(spark):
    rows = [(1, "a b c", "s", 5, 6, 7)] * 50 + [(i, "w " * (i % 7 + 1), "s", i, 1, 2) for i in range(2, 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _d1 bigint, d2 bigint, row bigint")
    out = M.mix(df)
    assert out.columns == df.columns
    kept, plan = Counter(collect(out)), Counter()
    for i, c in collect(M.mix_plan(df).select("doc_id", "copies")):
        plan[i] += c
    assert set(kept) <= set(rows) and Counter({r[0]: n for r, n in kept.items()}) == +plan
