"""SimHash near-duplicates: fingerprints linked through BK-trees.

1. Every text becomes a 64-bit SimHash of its word shingles (XXH64, seed 42).
   Copies collapse: later steps see each distinct fingerprint once.
2. Two fingerprints within ``radius`` bits agree on at least one of
   ``radius + 1`` bit blocks, two of ``radius + 2``, and so on (pigeonhole). A fingerprint
   belongs to one shard for each choice of blocks, named by some bits of them; as many
   bits as give shards of about ``SHARD`` members, so a search costs the same at every size.
   Every link lies inside a shard. Nothing is capped: a shard with more than
   ``TREE_SIZE`` members is dealt into tiles (tree i, queries j), i <= j.
3. A shard's members form a BK-tree: children hang on their parent under the
   integer Hamming distance to it. A query at distance d from a node follows
   only the edges from d - radius to d + radius. The tree is sent to the task
   that holds the shard's queries; it is bounded by ``TREE_SIZE`` members, so
   nothing that grows with the data is broadcast.
4. A tile returns a spanning set of the links it found (at most one per
   member), and :mod:`gatehouse.llm.components` joins them to components.

Trees are built and searched level by level with numpy for all shards of a
batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehouse.llm.common import as_bytes, byte_chunks, written
from gatehouse.llm.components import connected_components

SEED = 42
TREE_SIZE = 8192        # most members of one tree; larger shards are tiled, not cut
SHARD = 2048            # members of a shard on average, up to twice that
FRONTIER = 1 << 20      # (query, node) pairs examined at a time
CHUNK = 1 << 20         # bytes of a text split into words at a time
SIGN = -(1 << 63)


# ---------------------------------------------------------------- fingerprints

def bit_votes(text: bytes, shingle: int, seed: int) -> tuple[np.ndarray, int]:
    """How many shingle hashes set each bit, and the number of shingles."""
    from xxhash import xxh64_intdigest
    votes, total, tail = np.zeros(64, np.int64), 0, []
    for chunk in byte_chunks(text.lower(), CHUNK):      # bytes.lower folds A-Z only
        words = tail + chunk.split()                    # splits at 20 and 09-0D only
        if len(words) < shingle:
            tail = words
            continue
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        m = len(words) - shingle + 1
        h = np.fromiter(map(xxh64_intdigest, grams, repeat(seed)), np.uint64, m)
        votes += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
        total += m
        tail = words[m:]
    if total == 0 and tail:                             # fewer words than a shingle
        h = np.array([xxh64_intdigest(b" ".join(tail), seed)], "<u8")
        votes, total = np.unpackbits(h.view(np.uint8), bitorder="little").astype(np.int64), 1
    return votes, total


def simhash(text: bytes | None, shingle: int = 3, seed: int = SEED) -> int:
    """The fingerprint as a signed 64-bit integer; zero for a text without words."""
    votes, total = bit_votes(text or b"", shingle, seed)
    bits = np.packbits(2 * votes > total, bitorder="little") if total else np.zeros(8, np.uint8)
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text: str, keep: dict[str, Column], shingle: int = 3,
                 seed: int = SEED) -> DataFrame:
    """``keep`` (name: column) and ``fp`` for every row of ``docs``."""
    import pyarrow as pa
    names = list(keep)
    src = docs.select(*(c.alias(n) for n, c in keep.items()), F.col(text).cast("string").alias("_text"))
    schema = src.select(*names).withColumn("fp", F.lit(0).cast("bigint")).schema

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            fp = [simhash(t, shingle, seed) for t in as_bytes(batch.column(len(names)))]
            cols = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fp, pa.int64())], names=[*names, "fp"])

    return src.mapInArrow(run, schema)


# ---------------------------------------------------------------- BK-trees

class Forest:
    """BK-trees over ``fp`` (uint64), one for each value of ``tree`` (sorted)."""

    def __init__(self, fp: np.ndarray, tree: np.ndarray):
        self.fp, self.examined = fp, 0                              # examined: (query, node) pairs so far
        n = len(fp)
        first = np.r_[True, tree[1:] != tree[:-1]] if n else np.zeros(0, bool)
        self.roots = np.flatnonzero(first)
        at = np.repeat(self.roots, np.diff(np.r_[self.roots, n]))   # node each item stands at
        left = np.flatnonzero(~first)                               # items not yet in a tree
        edges = []                                                  # (parent * 128 + distance, child)
        while len(left):
            here = at[left]
            key = here * 128 + np.bitwise_count(fp[left] ^ fp[here]).astype(np.int64)
            uniq, pos, inv = np.unique(key, return_index=True, return_inverse=True)
            child = left[pos]
            edges.append(np.stack([uniq, child]))
            at[left] = child[inv]
            keep = np.ones(len(left), bool)
            keep[pos] = False
            left = left[keep]
        e = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), np.int64)
        order = np.argsort(e[0], kind="stable")
        self.edge, self.child = e[0][order], e[1][order]

    def near(self, fp: np.ndarray, root: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches of (query, node) within ``radius`` bits; ``root``: each query's tree."""
        todo = [(np.arange(len(fp)), root)]
        while todo:
            q, node = todo.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                todo += [(q[:half], node[:half]), (q[half:], node[half:])]
                continue
            self.examined += len(q)
            d = np.bitwise_count(fp[q] ^ self.fp[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            lo = np.searchsorted(self.edge, node * 128 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.edge, node * 128 + d + radius, "right")
            k = hi - lo
            q, lo, k = q[k > 0], lo[k > 0], k[k > 0]
            if len(q):
                step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                todo.append((np.repeat(q, k), self.child[np.repeat(lo, k) + step]))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked items the same, smallest label (labels point at items)."""
    while True:
        la, lb = label[a], label[b]
        ne = la != lb
        if not ne.any():
            return
        a, b, la, lb = a[ne], b[ne], la[ne], lb[ne]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label[:] = nxt


def spanning_links(gid: np.ndarray, query: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components found in each group.

    Rows are sorted by (gid, query). In a group with rows of ``query`` false
    and true, the former are the tree and the latter search it; a group with
    only ``query`` false searches its own tree.
    """
    n = len(fp)
    if not n:
        return fp[:0], fp[:0]
    size = np.diff(np.r_[np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]]), n])
    many = np.repeat(size > 1, size)
    gid, query, fp = gid[many], query[many], fp[many]
    n = len(fp)
    if not n:
        return fp[:0], fp[:0]
    _, start, inv = np.unique(gid, return_index=True, return_inverse=True)
    mixed = np.zeros(len(start), bool)
    mixed[inv[query]] = True
    tree = np.flatnonzero(~query)
    seek = np.flatnonzero(query | ~mixed[inv])
    forest = Forest(fp[tree], inv[tree])
    root_of = np.full(len(start), -1)
    root_of[inv[tree][forest.roots]] = forest.roots
    seek = seek[root_of[inv[seek]] >= 0]
    label = np.arange(n)
    for q, node in forest.near(fp[seek], root_of[inv[seek]], radius):
        _merge(label, seek[q], tree[node])
    out = np.flatnonzero(label != np.arange(n))
    return fp[label[out]], fp[out]


# ---------------------------------------------------------------- Spark plan

def shard_blocks(count: int, radius: int, members: int = SHARD) -> tuple[int, int, int]:
    """(blocks, agreeing, bits): how to cut fingerprints so that ``count`` of them lie in shards of about ``members``.

    Two fingerprints within ``radius`` bits agree on at least ``blocks - radius`` of so many blocks; a shard is
    named by ``bits`` bits of each of as many blocks. The fewest blocks that give enough bits are taken.
    """
    wanted = max(0, (count // members).bit_length() - 1)
    blocks = radius + 1
    while blocks < 64 and wanted > (blocks - radius) * (64 // blocks):
        blocks += 1
    agreeing = blocks - radius
    return blocks, agreeing, min(64 // blocks, -(-wanted // agreeing))


def _shard_keys(blocks: int, agreeing: int, bits: int) -> Column:
    """The shards of ``fp``: one for each choice of blocks; a single one where no bits are needed."""
    if not bits:
        return F.array(F.struct(F.lit(0).alias("t"), F.lit(0).cast("bigint").alias("bits")))
    part = [F.shiftrightunsigned("fp", 64 * i // blocks).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(blocks)]
    return F.array(*(F.struct(F.lit(t).alias("t"), reduce(lambda a, b: F.shiftleft(a, bits).bitwiseOR(b), [part[i] for i in some]).alias("bits"))
                     for t, some in enumerate(combinations(range(blocks), agreeing))))


def fingerprint_links(distinct: DataFrame, radius: int = 3, tree_size: int = TREE_SIZE, members: int = SHARD) -> DataFrame:
    """(a, b): links that connect all ``fp`` within ``radius`` bits of each other."""
    import pyarrow as pa
    shards = _shard_keys(*shard_blocks(distinct.count(), radius, members))
    keyed = distinct.select("fp", F.explode(shards).alias("k")).select("fp", "k.t", "k.bits")
    large = (keyed.groupBy("t", "bits").count().where(F.col("count") > tree_size)
             .select("t", "bits", F.ceil(F.col("count") / tree_size).cast("int").alias("n")))
    large = written(large, "simhash-large")
    small = keyed
    tiles = None
    if not large.isEmpty():
        small = keyed.join(large, ["t", "bits"], "left_anti")
        own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
        dealt = keyed.join(large, ["t", "bits"]).withColumn("own", own)
        each = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda o: F.struct(
            F.least(F.col("own"), o).alias("i"), F.greatest(F.col("own"), o).alias("j")))
        tiles = (dealt.select("fp", "t", "bits", "own", F.explode(each).alias("e"))
                 .select("fp", "t", "bits", "e.i", "e.j",
                         ((F.col("e.i") != F.col("e.j")) & (F.col("own") == F.col("e.j"))).alias("q")))
    zero = F.lit(0).cast("int")
    rows = small.select("fp", "t", "bits", zero.alias("i"), zero.alias("j"), F.lit(False).alias("q"))
    rows = rows.unionByName(tiles) if tiles is not None else rows
    order = ["t", "bits", "i", "j"]
    rows = rows.repartition(*order).sortWithinPartitions(*order, "q")

    def run(batches: Iterator) -> Iterator:
        held = None                 # rows of the last group seen, which may go on
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            if not len(cols[0]):
                continue
            change = np.zeros(len(cols[0]), bool)
            for c in cols[1:5]:
                change[1:] |= c[1:] != c[:-1]
            gid = np.cumsum(change)
            cut = int(np.searchsorted(gid, gid[-1]))
            held = [c[cut:] for c in cols]
            yield from links(gid[:cut], cols[5][:cut], cols[0][:cut])
        if held is not None:
            yield from links(np.zeros(len(held[0]), np.int64), held[5], held[0])

    def links(gid, q, fp) -> Iterator:
        a, b = spanning_links(gid, q.astype(bool), fp.view(np.uint64), radius)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                             names=["a", "b"])

    return rows.select("fp", *order, "q").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id of the rows reachable over links
    of at most ``radius`` differing bits. Null and empty texts have the
    fingerprint zero and are linked like any other; a component whose ids are
    all null has a null component. Repeated rows come out as often as they
    went in; an empty table gives an empty result. Other columns are ignored.
    """
    rows = written(fingerprints(docs, text, {"doc_id": F.col(doc_id)}, shingle), "simhash-rows")
    least = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    member = component_members(least.select("fp"), radius)
    named = written(least.join(member, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "low"),
                    "simhash-named")
    comp = written(named.groupBy("root").agg(F.min("low").alias("component_id")), "simhash-components")
    byfp = written(named.select("fp", "root").join(comp, "root").select("fp", "component_id"), "simhash-members")
    return rows.join(byfp, "fp").select("doc_id", "fp", "component_id")


def component_members(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, root) for the distinct fingerprints that have a link."""
    cc = connected_components(fingerprint_links(distinct, radius))
    return cc.select(F.col("node").alias("fp"), "root")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
             radius: int = 3) -> DataFrame:
    """``docs``, same columns (of any names), with one row of each near-duplicate component, the one of the
    smallest doc_id.

    Rows without an id stand behind all others; among rows of the same id the
    one with the smallest row hash stays, and of wholly equal rows one stays. Null and
    empty texts have the fingerprint zero and are linked like any other; an empty table gives an empty result.
    """
    cols = [F.col(f"`{c}`") for c in sorted(docs.columns)]
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         F.xxhash64(*cols).alias("d1"), F.xxhash64(F.lit("second"), *reversed(cols)).alias("d2"))
    own_id = F.col("row").getField(doc_id)
    rank = F.struct(own_id.isNull().alias("no_id"), own_id.alias("id"), "d1", "d2")
    rows = fingerprints(packed.withColumn("text", F.col("row").getField(text)), "text", {"rank": rank}, shingle)
    best = written(rows.groupBy("fp").agg(F.min("rank").alias("rank")), "simhash-best")
    member = component_members(best.select("fp"), radius)
    keep = written(best.join(member, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
                   .agg(F.min("rank").alias("rank")).select("rank.d1", "rank.d2"), "simhash-keep")
    return (packed.join(keep, ["d1", "d2"], "left_semi").dropDuplicates(["d1", "d2"])
            .select(*(F.col("row").getField(c).alias(c) for c in docs.columns)))


def hex16(fp: Column | str) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
