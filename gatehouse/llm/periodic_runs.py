"""Periodic runs of words, by enumerating maximal pairs.

Two places of a text that agree in exactly ``l`` words and differ in the word
before them are a maximal pair. Where they lie ``p`` words apart and ``l`` is at
least ``p``, the text from the first place on has period ``p`` for ``l + p`` words and
no word on either side continues it: such a pair *is* a run, and nothing has to
be extended. Maximal pairs are read off the tree of LCP intervals, bottom up:
when two children meet in a node of depth ``l``, each place of the smaller one
looks for places of the other within the reach that the run's exponent allows.

The class lists of a node (its places by the word to their left) are kept as one
list in text order, the class read from the text: places of one node that
lie within ``l / 2`` of each other form an arithmetic progression, in which
all but the first follow the same word. So the places behind a place are partners
all or none, and before it only the first in reach can be one. That needs
runs of at least three periods.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehouse.llm.common import as_bytes

BLOCK = 400_000         # words looked at together, whole texts
ROWS = 256              # texts of a batch held as lists of words
RUN = "struct<start: bigint, length: bigint, period: bigint>"
MADE = ("n_words", "runs", "collapsed")


class Numbers(dict):
    """Words to numbers, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def least_pair(length: int, exponent: int) -> int:
    """Words in which the maximal pair of any run of at least ``length`` words and ``exponent`` periods agrees."""
    return min(max((exponent - 1) * p, length - p) for p in range(1, length + 1))


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-spread bits of each number."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0x94D049BB133111EB)


def repeating(ids: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the texts in which some ``width`` (a power of two) words occur twice, by
    their hashes: further texts may be among them, none is missing."""
    starts = np.r_[0, ends[:-1]]
    text = np.repeat(np.arange(len(ends)), ends - starts)
    h, k = mixed(ids.astype(np.uint64)), 1
    while k < width and len(h) > k:
        h = mixed(h[:-k]) + h[k:]
        k *= 2
    at = np.flatnonzero(np.arange(len(h)) + width <= ends[text[:len(h)]]) if k == width else np.zeros(0, int)
    h = h[at] ^ mixed(text[at].astype(np.uint64))
    s = np.sort(h)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return twice.astype(int)
    near = twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)]
    return np.unique(text[at[near == h]])


def suffix_order(ids: np.ndarray, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The places in order of their suffixes (each text by itself), and for each power
    of two the rank of the words from a place on, as many as that, by prefix doubling.

    Only places whose rank is still shared are sorted again.
    """
    n = len(ids)
    key = text * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    head = np.r_[True, key[order[1:]] != key[order[:-1]]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, k = [rank.astype(np.int32)], 1
    while True:
        shared = np.flatnonzero(~(head & np.r_[head[1:], True]))
        if not len(shared):
            return order, levels
        at = order[shared]
        to = at + k
        key = rank[at] * (n + 1) + np.where(to < ends[at], rank[np.minimum(to, n - 1)] + 1, 0)
        o = np.argsort(key, kind="stable")
        at, key = at[o], key[o]
        new = np.r_[True, key[1:] != key[:-1]]
        order[shared], head[shared] = at, new
        rank[at] = shared[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        levels.append(rank.astype(np.int32))
        k *= 2


def common_words(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from the places ``a`` and ``b`` on agree."""
    n, out = len(levels[0]), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + out, b + out
        same = (x < n) & (y < n)
        same[same] = levels[k][x[same]] == levels[k][y[same]]
        out += same.astype(np.int64) << k
    return out


class Pairs:
    """Maximal pairs of one group of places, bottom up in the tree of its LCP intervals."""

    def __init__(self, left: list[int], length: int, exponent: int):
        self.left, self.length, self.exponent = left, length, exponent
        self.found: dict[tuple[int, int], int] = {}             # (start, end) to least period

    def pair(self, i: int, j: int, l: int) -> None:
        p = j - i
        if l + p >= self.length:
            key = (i, j + l)
            if p < self.found.get(key, p + 1):
                self.found[key] = p

    def meet(self, a: list[int], b: list[int], l: int) -> list[int]:
        """Pairs between the places of two children of a node of depth ``l``; the places of both."""
        few, many = (a, b) if len(a) < len(b) else (b, a)
        reach, left = l // (self.exponent - 1), self.left
        for i in few:
            at = bisect_left(many, i)
            if at < len(many) and many[at] - i <= reach and left[many[at]] != left[i]:
                for j in many[at:bisect_right(many, i + reach)]:
                    self.pair(i, j, l)
            if at and many[at - 1] >= i - reach:
                j = many[bisect_left(many, i - reach)]
                if left[j] != left[i]:
                    self.pair(j, i, l)
        if len(few) < 8:
            for i in few:
                insort(many, i)
        else:
            many += few
            many.sort()                                         # two sorted runs: linear
        return many

    def tree(self, places: list[int], lcp: list[int]) -> None:
        """``lcp[k]``: words in which ``places[k]`` and ``places[k + 1]`` agree."""
        open_, here = [], [places[0]]
        for place, l in zip(places[1:], lcp):
            while open_ and open_[-1][0] > l:
                depth, before = open_.pop()
                here = self.meet(before, here, depth)
            if open_ and open_[-1][0] == l:
                open_[-1][1] = self.meet(open_[-1][1], here, l)
            else:
                open_.append([l, here])
            here = [place]
        while open_:
            depth, before = open_.pop()
            here = self.meet(before, here, depth)


def runs_of(ids: np.ndarray, ends: np.ndarray, length: int = 24, exponent: int = 3) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period), by start and period, of each text that has some.

    ``ids`` are the texts' words as numbers, one text behind the other; ``ends`` the texts' ends.
    """
    if exponent < 3:
        raise ValueError("runs of fewer than three periods are not looked for")
    least = least_pair(length, exponent)
    width = 1 << (least.bit_length() - 1)
    which = repeating(ids, ends, width)
    if not len(which):
        return {}
    starts = np.r_[0, ends[:-1]]
    ids = np.concatenate([ids[starts[t]:ends[t]] for t in which])
    sizes = (ends - starts)[which]
    text = np.repeat(np.arange(len(which)), sizes)
    begin = np.cumsum(sizes) - sizes
    order, levels = suffix_order(ids, text, np.repeat(begin + sizes, sizes))
    if len(levels) <= width.bit_length() - 1:
        return {}
    ranks = levels[width.bit_length() - 1]
    near = np.flatnonzero(ranks[order[1:]] == ranks[order[:-1]])
    lcp = common_words(levels, order[near], order[near + 1])
    near, lcp = near[lcp >= least], lcp[lcp >= least]
    if not len(near):
        return {}
    left = np.r_[-1, ids[:-1]]
    left[begin] = -1                                            # a text's first place follows no word
    pairs = Pairs(left.tolist(), length, exponent)
    cuts = np.flatnonzero(np.diff(near) != 1) + 1
    for some, depth in zip(np.split(near, cuts), np.split(lcp, cuts)):
        pairs.tree(order[some[0]:some[-1] + 2].tolist(), depth.tolist())
    out: dict[int, list[tuple[int, int, int]]] = {}
    for (s, e), p in pairs.found.items():
        t = int(text[s])
        out.setdefault(int(which[t]), []).append((s - int(begin[t]), e - s, p))
    return {t: sorted(runs, key=lambda r: (r[0], r[2])) for t, runs in out.items()}


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those a run holds behind its first period."""
    kept = np.ones(len(words), bool)
    for s, n, p in runs:
        kept[s + p:s + n] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def find_runs(docs: DataFrame, text: str = "text", length: int = 24, exponent: int = 3,
              carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all but the text), ``n_words``, ``runs`` (array of start,
    length and period, in words from 0, by start and period) and ``collapsed``, the
    text's words joined by one blank without those a run holds behind its first period.

    A run is a stretch of at least ``length`` words and ``exponent`` (three or more)
    smallest periods that no neighbouring word continues. Words are what stands
    between ASCII blanks. Null and empty texts have no words, no runs and an empty
    ``collapsed``; repeated rows give repeated results; an empty table gives an empty
    result. Columns of the names made here are replaced. Each text is looked at
    by itself and whole.
    """
    import pyarrow as pa
    carry = carry if carry is not None else [c for c in docs.columns if c not in (text, *MADE)]
    src = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry), F.lit(0).alias("")).alias("row"),
                      F.col(f"`{text}`").cast("string").alias("text"))
    schema = (src.select("row").withColumn("n_words", F.lit(None).cast("bigint"))
              .withColumn("runs", F.lit(None).cast(f"array<{RUN}>")).withColumn("collapsed", F.lit(None).cast("string")).schema)
    run_t = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def done(rows: list, texts: list[list[bytes]], ids: list[np.ndarray]) -> Iterator:
        sizes = [len(w) for w in texts]
        found = runs_of(np.concatenate([*ids, np.zeros(0, np.int64)]), np.cumsum(sizes), length, exponent)
        runs = [[{"start": s, "length": n, "period": p} for s, n, p in found.get(t, ())] for t in range(len(texts))]
        text = [b" ".join(collapse(w, found[t]) if t in found else w) for t, w in enumerate(texts)]
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays(rows), pa.array(sizes, pa.int64()), pa.array(runs, run_t), pa.array(text, pa.binary()).view(pa.string())],
            names=["row", *MADE])

    def run(batches: Iterator) -> Iterator:
        rows, texts, ids, size, number = [], [], [], 0, Numbers()
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                some = batch.slice(at, ROWS)
                for t in as_bytes(some.column(1)):
                    words = (t or b"").split()
                    texts.append(words)
                    ids.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                    size += len(words)
                rows.append(some.column(0))
                if size >= BLOCK:
                    yield from done(rows, texts, ids)
                    rows, texts, ids, size, number = [], [], [], 0, Numbers()
        if rows:
            yield from done(rows, texts, ids)

    out = src.mapInArrow(run, schema)
    return out.select(*(F.col("row").getField(c).alias(c) for c in carry), *MADE)


def best_run(runs: str) -> Column:
    """The run of the greatest exact length / period, ties to the smaller start, then period; null if none."""
    def better(a: Column, r: Column) -> Column:
        more = r["length"] * a["period"] > a["length"] * r["period"]
        return F.when(a.isNull() | more, r).otherwise(a)
    return F.reduce(runs, F.lit(None).cast(RUN), better)
