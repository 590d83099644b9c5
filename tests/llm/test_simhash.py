import random

import numpy as np
import pytest
import xxhash

from gatehouse.llm import simhash_bk as S
from gatehouse.llm.components import connected_components
from tests.llm.frames import LONG, collect, docs


def plain_simhash(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(g, seed=42) >> bit & 1 for g in grams)
        out |= (2 * ones > len(grams)) << bit
    return out


def plain_components(fps):
    """fp -> set of fps reachable over links of at most 3 bits."""
    left, out = set(fps), {}
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            a = todo.pop()
            seen.add(a)
            near = {b for b in left if bin(a ^ b).count("1") <= 3}
            left -= near
            todo += near
        out.update({a: seen for a in seen})
    return out


@pytest.mark.parametrize("text", ["", " \t\n", "one", "one two", "one two three", "A b C d É É f\x0bg\x0ch i",
                                  "a b c d e", "x " * 5000])
def test_fingerprint(text):
    assert S.simhash(text.encode()) % 2**64 == plain_simhash(text)


def test_fingerprint_of_a_long_text_is_read_in_chunks(monkeypatch):
    text = " ".join(random.Random(1).choices("ab cd ef gh ij kl".split(), k=4000))
    whole = S.simhash(text.encode())
    monkeypatch.setattr(S, "CHUNK", 97)
    assert S.simhash(text.encode()) == whole == np.uint64(plain_simhash(text)).astype(np.int64)


def neighbours(seed, n):
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(n)]
    out = list(base)
    for b in base[:n // 2]:
        for _ in range(r.randint(1, 4)):
            b ^= sum(1 << k for k in r.sample(range(64), r.randint(1, 4)))
            out.append(b)
    return sorted(set(out))


@pytest.mark.parametrize("frontier", [1 << 20, 50])
def test_bk_tree_finds_all_neighbours(monkeypatch, frontier):
    monkeypatch.setattr(S, "FRONTIER", frontier)
    fps = np.array(neighbours(3, 300), np.uint64)
    tree = np.arange(len(fps)) // 100
    forest = S.Forest(fps, tree)
    root = forest.roots[tree]
    got = {(int(q), int(n)) for qs, ns in forest.near(fps, root, 3) for q, n in zip(qs, ns)}
    want = {(i, j) for i in range(len(fps)) for j in range(len(fps))
            if tree[i] == tree[j] and bin(int(fps[i]) ^ int(fps[j])).count("1") <= 3}
    assert got == want


def test_shards_hold_every_link_and_about_as_many_members():
    for count in (0, 1, 4000, 10**5, 10**7, 10**9, 10**11, 10**13):
        blocks, agreeing, bits = S.shard_blocks(count, 3)
        assert agreeing == blocks - 3 >= 1 and bits * blocks <= 64          # three bits spoil at most three blocks
        size = count / 2 ** (bits * agreeing)
        assert count < 2 * S.SHARD or S.SHARD / 2 ** agreeing <= size < 2 * S.SHARD
    assert S.shard_blocks(10**5, 3)[:2] == (4, 1)


def test_trees_of_thousands_follow_few_edges():
    r = np.random.default_rng(0)
    fps = r.integers(0, 2**64, 3000, dtype=np.uint64)
    forest = S.Forest(fps, np.zeros(len(fps), np.int64))
    got = sum(len(q) for q, _ in forest.near(fps, np.zeros(len(fps), np.int64), 3))
    assert got == len(fps) and forest.examined < 0.12 * len(fps) ** 2       # each finds itself; most edges are not followed


@pytest.mark.parametrize("tree_size,members", [(8192, 2048), (5, 2048), (8192, 16), (5, 4), (8192, 1)])
def test_links_connect_what_brute_force_connects(spark, tree_size, members):
    fps = neighbours(5, 150) + [0]
    hub = 0x0F0F
    fps = sorted(set(fps) | {hub ^ (1 << k) for k in range(40)} | {hub})     # one shard far above the tree size
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp bigint")
    links = S.fingerprint_links(df, 3, tree_size, members)
    cc = {n % 2**64: r % 2**64 for n, r in collect(connected_components(links))}
    want = plain_components(fps)
    for f in fps:
        same = {g for g in fps if cc.get(g, g) == cc.get(f, f)}
        assert same == want[f]


def test_components_of_chains_stars_and_bad_links(spark):
    rows = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 50)] + [(5000, 5000), (None, 3), (7, None), (0, 1)]
    cc = dict(collect(connected_components(spark.createDataFrame(rows, "a bigint, b bigint"))))
    assert cc == {**{i: 0 for i in range(201)}, **{1000 + k: 1000 for k in range(50)}}
    assert collect(connected_components(spark.createDataFrame([], "a bigint, b bigint"))) == []


TEXT = "the quick brown fox jumps over the lazy dog while the cat sleeps on the warm stone wall " * 20


def rows():
    near = TEXT.replace("lazy dog while", "lazy hound while", 1)
    return [(5, TEXT), (3, TEXT), (9, near), (9, near), (1, None), (2, ""), (4, "  \n"), (6, "something else entirely here now"),
            (None, TEXT), (None, "an orphan text of its own"), (8, LONG)]


def test_near_duplicates(spark):
    got = sorted(collect(S.near_duplicates(docs(spark, rows()))), key=str)
    fps = [plain_simhash(t or "") if t != LONG else S.simhash(LONG.encode()) % 2**64 for _, t in rows()]
    comp = plain_components(fps)
    want = []
    for (i, _), f in zip(rows(), fps):
        ids = [j for (j, _), g in zip(rows(), fps) if g in comp[f] and j is not None]
        want.append((i, f - 2**64 if f >= 2**63 else f, min(ids) if ids else None))
    assert got == sorted(want, key=str)
    assert len({c for i, _, c in got if i in (3, 5, 9)}) == 1


def test_keep_one(spark):
    df = docs(spark, rows())
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, TEXT), (1, None), (6, rows()[7][1]), (8, LONG), (None, "an orphan text of its own")], key=str)


def test_empty_table(spark):
    assert collect(S.near_duplicates(docs(spark, []))) == []
    assert collect(S.keep_one(docs(spark, []))) == []
