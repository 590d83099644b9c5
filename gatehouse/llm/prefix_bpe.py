"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece there is exactly one last token its BPE
encoding can have. The table of these last tokens is the whole state: the
encoding is read off backwards, appending bytes extends the table without
touching what is there, and an edit recomputes only the prefixes from the edit
up to the place where the table agrees with its old self again.

A token ``t`` that ends at prefix ``i`` is the last one if the last token
``u`` of the prefix before it may stand next to it, that is, if no merge across
the border of ``u`` and ``t`` would have come before the merges that build
them. That needs the merge trees of both: the tokens on the right edge of
``u`` and on the left edge of ``t``, each alive from its own merge to its
parent's.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehouse.llm.common import Kept, cut_words

WORDS = 300_000         # words, and
PIECES = 20_000         # other pieces of a generation kept in a Python worker
PAIRS = 250_000         # pairs of tokens whose border is known; emptied when full
MARKS = frozenset(",.;:!?")    # a piece of their own behind letters
ROWS = 512              # texts of a batch held as Python strings


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a rank file (base64, blank, rank)."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def merge_tree(ranks: dict[bytes, int]) -> np.ndarray:
    """(left, right) child of each token, -1 where there is none.

    The last merge of a token joins the two parts its bytes have after all
    merges of lower rank. A token those merges cannot build is unreachable and
    gets (-2, -2): it only ever stands for a whole piece.
    """
    size = max(ranks.values()) + 1
    tree = np.full((size, 2), -1, np.int32)
    for token, rank in ranks.items():
        if len(token) > 1:
            parts = _merge_below(token, rank, ranks)
            tree[rank] = [ranks[p] for p in parts] if len(parts) == 2 else -2
    return tree


def _merge_below(data: bytes, limit: int, ranks: dict[bytes, int]) -> list[bytes]:
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best, at = limit, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1], limit)
            if r < best:
                best, at = r, i
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Vocabulary:
    """Ranks with what the dynamic program needs; small enough to broadcast."""

    def __init__(self, ranks: dict[bytes, int], tree: np.ndarray):
        self.ranks, self.tree = ranks, tree
        self.bytes_of: list[bytes] = [b""] * len(tree)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        # tokens a merge sequence can build, by bytes
        self.built = {t: r for t, r in ranks.items() if tree[r, 0] != -2}
        self.longest = max(map(len, self.built))
        # finds all tokens that end at each byte, the longest first
        self.ending = ahocorasick.Automaton()
        for t, r in self.built.items():
            self.ending.add_word(t.decode("latin-1"), (len(t), r))
        self.ending.make_automaton()
        self._edge: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}
        self._pair: dict[int, bool] = {}

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """(bytes, merged at, consumed at) of the tokens on one edge, outermost first."""
        got = self._edge.get((token, side))
        if got is None:
            got, until, t = [], 1 << 60, token
            while t >= 0:
                inner = int(self.tree[t, side])
                since = t if inner >= 0 else -1         # single bytes are there from the start
                got.append((self.bytes_of[t], since, until))
                until, t = since, inner
            self._edge[token, side] = got
        return got

    def adjacent(self, u: int, t: int) -> bool:
        """Whether the encoding of the bytes of ``u`` and ``t`` is just these two."""
        key = u << 32 | t
        ok = self._pair.get(key)
        if ok is None:
            ok = True
            left, right = self._spine(u, 1), self._spine(t, 0)
            i = j = 0
            while i < len(left) and j < len(right):
                (a, a0, a1), (b, b0, b1) = left[i], right[j]
                m = self.ranks.get(a + b)
                # the pair stands side by side from max(a0, b0); on equal rank
                # the leftmost merge comes first: a's own before, b's own after
                if m is not None and m < a1 and m <= b1 and m > max(a0, b0):
                    ok = False
                    break
                if a0 > b0:
                    i += 1
                else:
                    j += 1
            if len(self._pair) >= PAIRS:
                self._pair.clear()
            self._pair[key] = ok
        return ok

    def extend(self, data: bytes, last: list[int], to: int | None = None) -> None:
        """Append the last token of each further prefix of ``data`` to ``last``."""
        done, known, adjacent = len(last), self._pair.get, self.adjacent
        start = max(0, done - self.longest)
        for end, (k, t) in self.ending.iter(data[start:to].decode("latin-1")):
            end += start + 1
            if end > done:
                if k < end:
                    u = last[end - k - 1]
                    ok = known(u << 32 | t)
                    if ok is False or (ok is None and not adjacent(u, t)):
                        continue
                last.append(t)
                done = end

    def read_back(self, last: list[int]) -> list[int]:
        """The encoding, from the table of last tokens."""
        out, i = [], len(last)
        while i:
            out.append(last[i - 1])
            i -= len(self.bytes_of[last[i - 1]])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(data, last)
        return self.read_back(last)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixEncoding:
    """The encoding of one growing or edited piece of bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of data[start:end]; returns the prefixes recomputed."""
        v, old, shift = self.vocabulary, self.last, len(new) - (end - start)
        data = self.data[:start] + new + self.data[end:]
        last, same = old[:start], 0
        i = start
        while i < len(data):
            i += 1
            v.extend(data, last, i)
            # behind the edit, a run of unchanged last tokens as long as the
            # longest token means that all that follows is unchanged too
            j = i - shift
            same = same + 1 if j > end and last[i - 1] == old[j - 1] else 0
            if same >= v.longest:
                last += old[j:]
                break
        self.data, self.last = data, last
        return i - start

    def tokens(self) -> list[int]:
        whole = self.vocabulary.ranks.get(self.data)
        return [whole] if whole is not None else self.vocabulary.read_back(self.last)


class Encoder:
    """Whole texts: the pattern's pieces, each encoded on its own.

    A blank between two non-space characters always opens a piece, so a text is
    cut there first; words and pieces met lately are not encoded again.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex
        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self.pieces, self.words = Kept(self.piece, PIECES), Kept(self.word, WORDS)

    def piece(self, p: str) -> bytes:
        return array("i", self.vocabulary.encode_piece(p.encode())).tobytes()

    def text(self, t: str) -> bytes:
        words, pieces = self.words, self.pieces
        return b"".join([words[p[1:]] if p[0] == " " and p[1:].isalpha() else pieces[p] for p in self.find(t)])

    def word(self, w: str) -> bytes:
        """A word behind a blank."""
        if w.isalpha():
            return self.piece(" " + w)
        if w[:-1].isalpha() and w[-1] in MARKS:
            return self.words[w[:-1]] + self.pieces[w[-1]]
        return self.text(" " + w)

    def packed(self, text: str) -> bytes:
        """The ids of the text, 32 bits each."""
        first, rest = cut_words(text)
        opening = self.text(first) if first else b""
        return opening + b"".join(map(self.words.__getitem__, rest))

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()


def load_vocabulary(path: str) -> tuple[dict[bytes, int], np.ndarray]:
    """Ranks and merge tree of the rank file at ``path``, read on the driver.

    The file lies beside the driver's libraries; executors get what they need
    from the driver, so they need no copy of it.
    """
    with open(path, "rb") as f:
        ranks = read_ranks(f.read())
    return ranks, merge_tree(ranks)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text",
           carry: list[str] | None = None, decoded: str | None = None) -> DataFrame:
    """``carry`` columns (default: all but the text) and ``ids``, array<int>; with ``decoded`` also a
    column of that name, the bytes that the ids stand for (as :func:`decode`, in the same pass).

    Special tokens are ordinary text. Null and empty texts have no ids;
    repeated rows give repeated results; an empty table gives an empty result.
    """
    import pyarrow as pa
    carry = carry if carry is not None else [c for c in docs.columns if c not in (text, "ids", decoded)]
    src = docs.select(*(F.col(f"`{c}`") for c in carry), F.col(text).cast("string").alias("_text"))
    schema = src.drop("_text").withColumn("ids", F.array().cast("array<int>")).schema
    if decoded:
        schema = schema.add(decoded, "binary")
    held = docs.sparkSession.sparkContext.broadcast({"file": load_vocabulary(path)})  # one fixed file
    n = len(carry)

    def run(batches: Iterator) -> Iterator:
        mine = held.value               # a worker has one for all its tasks, and with it the words it has met
        if "encoder" not in mine:
            mine["encoder"] = Encoder(Vocabulary(*mine["file"]), pattern)
        packed, token = mine["encoder"].packed, mine["encoder"].vocabulary.bytes_of.__getitem__
        for batch in batches:
            for at in range(0, len(batch), ROWS):       # a few texts as Python strings at a time
                some = batch.slice(at, ROWS)
                ids = [packed(t or "") for t in some.column(n).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                cols = [*(some.column(i) for i in range(n)), flat]
                if decoded:
                    cols.append(pa.array([b"".join(map(token, np.frombuffer(x, np.int32).tolist())) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``tokens`` with the column ``out``: the bytes its ids stand for (null ids: none)."""
    import pyarrow as pa
    tokens = tokens.drop(out)
    names = tokens.columns
    at = names.index(ids)
    schema = tokens.withColumn(out, F.lit(None).cast("binary")).schema
    with open(path, "rb") as f:
        ranks = read_ranks(f.read())
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    held = tokens.sparkSession.sparkContext.broadcast(table)                   # one fixed file

    def run(batches: Iterator) -> Iterator:
        token = held.value.__getitem__
        for batch in batches:
            col = batch.column(at)
            flat = col.flatten().to_numpy(zero_copy_only=False).tolist()
            sizes = [x or 0 for x in pc.list_value_length(col).to_pylist()]
            texts, end = [], 0
            for k in sizes:
                texts.append(b"".join(map(token, flat[end:end + k])))
                end += k
            cols = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.binary())], names=[*names, out])

    import pyarrow.compute as pc
    return tokens.mapInArrow(run, schema)


def ids_digest(ids: Column | str) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids) if isinstance(ids, str) else ids, ",").cast("binary"), 256)
