"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of the rows its features pick from two tables:
the word itself and its first 3, 5 and 7 characters (so an inflected form says
what its stem says), each hashed twice, so two features share a vector only if
they collide twice. Filters of widths 1, 2 and 3 slide over the words; each
keeps its largest response (max pooling); a logistic layer weighs them.

Every labelled row takes part (all but the held-out ones), whole, and no row passes
the driver. The rows are dealt over units by a hash of their id and written in
hash order. Features seen in fewer than ``MIN_DF`` training texts (a count over
all of them) keep zero rows, so an unknown word says nothing. Learning takes
``ROUNDS`` rounds: each unit starts from the common model, learns from its share of the
rows in small batches with numpy, and returns what it changed; Spark averages that, an
embedding's row by how often each unit moved it. Small tables are visited in every
round, large ones once in all. The sums are of whole numbers, so the
model does not depend on the order in which tasks end.

Thresholds are calibrated by language: a fifth of the rows stays out of the rounds;
it is scored, its scores are counted by language and label, and
for each language (guessed from the text's own function words; the table's
column is never read) the cut with the best F1 is chosen, drawn towards the
common cut where a language has few rows. Scores are mapped so that this cut
becomes 0.5. Then a last, slow round learns from that fifth too.

Whole texts are scored. A text is read in chunks of ``CHUNK`` bytes, and the
pooled maxima of the chunks are merged, so memory does not grow with it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehouse.llm.common import as_bytes, byte_chunks, written

BUCKETS = 1 << 18       # rows of each of the two embedding tables
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8             # of each width
PREFIXES = (3, 5, 7)
REACH = 32              # bytes of the longest word; a longer run without blanks is read as
PIECE = 4               # overlapping pieces of so many characters, each half a piece on
MIN_DF = 5
SAMPLE_WORDS = 1_500_000
ROUNDS = 3
UNIT = 2000             # rows of a unit in a round, about
UNITS = 256             # at most; beyond, units grow
FEW = 24_000            # rows to learn from, below which they are visited again
BATCH = 16
WIDE = 1 << 16          # words of a text looked at together while learning
BINS = 10_000           # of the scores from which thresholds come
SCALE = 1 << 28         # of the whole numbers that are summed
CHUNK = 1 << 20
HOLD = 5                # one in HOLD rows sets the thresholds
CACHE = 200_000         # words whose vectors a task keeps
PAD = max(WIDTHS) - 1

# Frequent function words by which a text's language is guessed.
FUNCTION_WORDS = {
    "en": "the and of to in is that for it with as was on are by this be from or an have not which",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden",
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas plus au avec ce il sont",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o",
}
LANGUAGES = (*FUNCTION_WORDS, "other")

# ASCII punctuation becomes blank, A-Z becomes a-z; every other byte stays.
_TABLE = bytes(32 if (33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126)
               else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The words between blanks and ASCII punctuation, in lower case; all of a longer run counts, piece by piece."""
    words = text.translate(_TABLE).split()
    if max(map(len, words), default=0) <= REACH:
        return words
    return [p for w in words for p in ((w,) if len(w) <= REACH else pieces_of(w))]


def pieces_of(run: bytes) -> list[bytes]:
    chars = run.decode("utf-8", "replace")
    step = PIECE // 2
    return [chars[i:i + PIECE].encode() for i in range(0, max(1, len(chars) - step), step)]


def features(words: list[bytes]) -> np.ndarray:
    """Hashes (words, 1 + openings) of each word and of its openings; zero where it is too short.

    A polynomial hash over the bytes, mixed; the word itself also counts its length.
    """
    data = np.array(words, f"S{REACH}").view(np.uint8).reshape(len(words), REACH)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(REACH, 0x9E3779B97F4A7C15, np.uint64))
        sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power, axis=1)
        chars = np.cumsum((data & 0xC0 != 0x80) & (data != 0), axis=1)     # characters begun so far
        size = np.array(list(map(len, words)))
        at = [np.clip(size, 1, REACH) - 1]
        ok = [size > 0]
        for k in PREFIXES:
            end = (chars <= k).sum(axis=1)              # bytes of the first k characters (and zeros)
            at.append(np.clip(np.minimum(end, size), 1, REACH) - 1)
            ok.append((chars[:, -1] >= k))
        h = np.stack([sums[np.arange(len(words)), i] for i in at], axis=1)
        h += np.arange(len(at), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        h[:, 0] += size.astype(np.uint64)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.where(np.stack(ok, axis=1), np.maximum(h, 1), 0)


def rows_of(h: np.ndarray) -> np.ndarray:
    """Rows (2, words, features) of both tables; the last row, always zero, for none."""
    mask = np.uint64(BUCKETS - 1)
    rows = np.stack([h & mask, (h >> np.uint64(32)) & mask]).astype(np.int32)
    rows[:, h == 0] = BUCKETS
    return rows


class Vocabulary:
    """Numbers words as they come; keeps each word's feature rows and language votes."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.room = np.zeros((2, 1024, 1 + len(PREFIXES)), np.int32)       # feature rows, and space for more
        self.listed = {w.encode(): [w in ws.split() for ws in FUNCTION_WORDS.values()]
                       for ws in FUNCTION_WORDS.values() for w in ws.split()}

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray | None]:
        """Numbers of the words, and feature rows of those not seen before."""
        number = self.number
        fresh = sorted(w for w in set(words) if w not in number)
        rows = None
        if fresh:
            for w in fresh:
                number[w] = len(number)
            rows = rows_of(features(fresh))
        return np.fromiter(map(number.__getitem__, words), np.int64, len(words)), rows

    def add(self, words: list[bytes]) -> np.ndarray:
        known = len(self.number)
        ids, rows = self.ids(words)
        if rows is not None:
            need = known + rows.shape[1]
            if need > self.room.shape[1]:
                self.room = np.concatenate([self.room, np.zeros((2, need, self.room.shape[2]), np.int32)], axis=1)
            self.room[:, known:need] = rows
        return ids

    @property
    def rows(self) -> np.ndarray:
        return self.room[:, :len(self.number)]

    def votes(self, words: list[bytes]) -> np.ndarray:
        own = [self.listed[w] for w in words if w in self.listed]
        return np.sum(own, axis=0, dtype=np.float64) if own else np.zeros(len(FUNCTION_WORDS))


def guess_language(votes: np.ndarray) -> int:
    """Most function words wins; none or a tie is ``other``."""
    best = int(votes.argmax())
    return best if (votes == votes[best]).sum() == 1 else len(FUNCTION_WORDS)


class TextCNN:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rng = rng
        self.emb = [np.zeros((BUCKETS + 1, DIM), np.float32) for _ in range(2)]
        self.conv = [rng.normal(0, 0.4, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = np.abs(rng.normal(0.4, 0.1, len(WIDTHS) * FILTERS)).astype(np.float32)
        self.out0 = np.full(1, -2.0, np.float32)
        self.cut = np.full(len(LANGUAGES), 0.5)
        self.squares = [np.zeros((BUCKETS + 1, DIM), np.float32) for _ in range(2)]     # of the embeddings' gradients
        self.live = [np.zeros(BUCKETS + 1, bool) for _ in range(2)]
        self.m, self.v = ([np.zeros_like(p) for p in self.layers] for _ in range(2))
        self.steps = 0.0

    @property
    def layers(self) -> list[np.ndarray]:
        return [*self.conv, self.bias, self.out, self.out0]

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        """Word vectors from feature rows (2, words, features)."""
        x = np.zeros((rows.shape[1], DIM), np.float32)
        for e, r in zip(self.emb, rows):
            for k in range(r.shape[1]):
                x += e[r[:, k]]
        return x

    def responses(self, x: np.ndarray) -> np.ndarray:
        """Filter responses at every position of ``x``, zero rows behind its end."""
        n = len(x)
        wide = np.concatenate([x, np.zeros((PAD, DIM), np.float32)])
        out = []
        for w, c in zip(WIDTHS, self.conv):
            y = x @ c[0]
            for k in range(1, w):
                y += wide[k:n + k] @ c[k]
            out.append(y)
        return np.concatenate(out, axis=1)

    def probability(self, top: np.ndarray) -> np.ndarray:
        z = np.maximum(top + self.bias, 0) @ self.out + self.out0[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    # -- training

    def begin(self, live: list[np.ndarray]) -> None:
        """Small random rows for the features to learn; ``live``: their row numbers in each table."""
        for t, at in enumerate(live):
            self.live[t][at] = True
            self.emb[t][at] = self.rng.normal(0, 0.05, (len(at), DIM))

    @property
    def flat(self) -> np.ndarray:
        """The layers, both moments of their gradients and the steps so far, in one row of numbers."""
        return np.concatenate([a.ravel() for a in (*self.layers, *self.m, *self.v)] + [[self.steps]])

    def put_flat(self, flat: np.ndarray) -> None:
        at = 0
        for a in (*self.layers, *self.m, *self.v):
            a[...] = flat[at:at + a.size].reshape(a.shape)
            at += a.size
        self.steps = float(flat[at])

    @property
    def state(self) -> tuple:
        """All that learning goes on from; only live rows of the tables."""
        at = [np.flatnonzero(a) for a in self.live]
        return at, [e[a] for e, a in zip(self.emb, at)], [q[a] for q, a in zip(self.squares, at)], self.flat

    @classmethod
    def of(cls, state: tuple) -> TextCNN:
        at, emb, squares, flat = state
        model = cls()
        for t, a in enumerate(at):
            model.live[t][a], model.emb[t][a], model.squares[t][a] = True, emb[t], squares[t]
        model.put_flat(flat)
        return model

    def put(self, changed: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Take over (rows, values) of both tables and of the layers, as ``Learner.changes`` has them."""
        for t, (at, values) in enumerate(changed[:2]):
            self.emb[t][at], self.squares[t][at] = values[:, :DIM], values[:, DIM:]
        if len(changed[2][0]):
            self.put_flat(changed[2][1].ravel())

    def peaks(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter over a text, not below zero, and the words of its
        window, (filters, 3); word 0, which is none, behind the text's end."""
        count = len(self.out)
        top, words = np.zeros(count, np.float32), np.zeros((count, max(WIDTHS)), np.int64)
        ends = np.concatenate([ids, np.zeros(PAD, ids.dtype)])
        for at in range(0, len(ids), WIDE):
            resp = self.responses(self.vectors(rows[:, ids[at:at + WIDE + PAD]]))[:WIDE].T
            hit = resp.argmax(axis=1)
            best = resp[np.arange(count), hit]
            more = best > top
            top[more] = best[more]
            words[more] = ends[at + hit[more, None] + np.arange(max(WIDTHS))]
        return top, words

    def learn(self, texts: list[np.ndarray], y: np.ndarray, rows: np.ndarray, lr: float, moved: list[np.ndarray]) -> None:
        """One step on the word numbers of some texts; ``rows``: feature rows of the words, the first
        of none. Counts in ``moved`` which rows of the tables it changed."""
        top, words = map(np.stack, zip(*(self.peaks(ids, rows) for ids in texts)))
        act = np.maximum(top + self.bias, 0)
        d = ((self.probability(top) - y) / len(y)).astype(np.float32)
        dt = d[:, None] * self.out * (act > 0)
        g = [np.zeros_like(p) for p in self.layers]
        g[-3][:], g[-2][:], g[-1][:] = dt.sum(axis=0), d @ act, d.sum()
        dt = np.where(top > 0, dt, 0)           # none to the words where a text's end gave the zero
        at, gx = [], []
        for j, w in enumerate(WIDTHS):
            own = slice(j * FILTERS, (j + 1) * FILTERS)
            for k in range(w):
                word = words[:, own, k].ravel()
                x = self.vectors(rows[:, word]).reshape(len(y), FILTERS, DIM)
                g[j][k] = np.einsum("bf,bfd->df", dt[:, own], x)
                at.append(word)
                gx.append((dt[:, own, None] * self.conv[j][k].T).reshape(-1, DIM))
        self.steps += 1
        for p, m, v, gr in zip(self.layers, self.m, self.v, g):
            gr += 1e-4 * p
            m += 0.1 * (gr - m)
            v += 0.001 * (gr * gr - v)
            p -= lr * (m / (1 - 0.9 ** self.steps)) / (np.sqrt(v / (1 - 0.999 ** self.steps)) + 1e-8)
        word, gx = np.concatenate(at), np.concatenate(gx)
        some = gx.any(axis=1)
        for t in range(2):
            at_row = rows[t][word[some]]
            flat, back = np.unique(at_row, return_inverse=True)
            ge = np.zeros((len(flat), DIM), np.float32)
            np.add.at(ge, back.ravel(), np.repeat(gx[some], at_row.shape[1], axis=0))
            ok = self.live[t][flat]
            flat, ge = flat[ok], ge[ok]
            ge += 1e-4 * self.emb[t][flat]
            self.squares[t][flat] += ge * ge
            self.emb[t][flat] -= 2.5 * lr * ge / (np.sqrt(self.squares[t][flat]) + 1e-6)
            moved[t][flat] += 1

    # -- thresholds

    def calibrated(self, p: float, lang: int) -> float:
        """The probability, mapped so that the language's threshold becomes 0.5."""
        c = float(self.cut[lang])
        return 0.5 * p / c if p < c else 0.5 + 0.5 * (p - c) / (1 - c)

    def calibrate(self, p: np.ndarray, lang: np.ndarray, y: np.ndarray, prior: int = 50,
                  weight: np.ndarray | None = None) -> None:
        """A threshold for each language, drawn towards the common one; a row stands for ``weight`` texts."""
        weight = np.ones(len(y)) if weight is None else weight
        common = best_cut(p, y, weight)
        self.cut[:] = common
        for k in range(len(LANGUAGES)):
            own = lang == k
            if y[own].any() and not y[own].all():
                n = weight[own].sum()
                self.cut[k] = (n * best_cut(p[own], y[own], weight[own]) + prior * common) / (n + prior)


class DocumentCounts:
    """Number of texts with a feature in each row of both tables."""

    def __init__(self):
        self.df = np.zeros((2, BUCKETS + 1), np.int64)
        self.vocabulary = Vocabulary()

    def add(self, texts: list[list[bytes]]) -> None:
        if len(self.vocabulary.number) > CACHE:
            self.vocabulary = Vocabulary()
        distinct = [list(set(words)) for words in texts]
        ids = self.vocabulary.add([w for words in distinct for w in words])
        text = np.repeat(np.arange(len(texts)), [len(words) for words in distinct])
        for t in range(2):
            key = np.sort((text[:, None] * (BUCKETS + 1) + self.vocabulary.rows[t][ids]).ravel())
            key = key[np.diff(key, prepend=-1) != 0]            # a row once a text
            np.add.at(self.df[t], key % (BUCKETS + 1), 1)
        self.df[:, BUCKETS] = 0


class Learner:
    """Learns from texts one after the other, in batches, and says what has changed."""

    def __init__(self, model: TextCNN, lr: float):
        self.model, self.lr = model, lr
        self.reset()
        self.texts: list[list[bytes]] = []
        self.y: list[int] = []
        self.seen = 0
        self.moved = [np.zeros(BUCKETS + 1, np.int64) for _ in range(2)]

    def reset(self) -> None:
        self.vocabulary = Vocabulary()
        self.vocabulary.add([b""])          # word 0: none

    def add(self, words: list[bytes], y: int) -> None:
        self.texts.append(words)
        self.y.append(y)
        if len(self.y) == BATCH:
            self.step()

    def step(self) -> None:
        ids = self.vocabulary.add([w for words in self.texts for w in words])
        ends = np.cumsum([len(words) for words in self.texts])
        self.model.learn(np.split(ids, ends[:-1]), np.array(self.y), self.vocabulary.rows, self.lr, self.moved)
        self.seen += len(self.y)
        self.texts, self.y = [], []
        if len(self.vocabulary.number) > CACHE:
            self.reset()

    def changes(self) -> tuple[np.ndarray, ...]:
        """(table, row, weight, values): the embeddings' rows that moved, with the squares of their gradients; table 2: the layers."""
        if self.y:
            self.step()
        at = [np.flatnonzero(m) for m in self.moved]
        flat = self.model.flat
        flat = np.pad(flat, (0, -len(flat) % (2 * DIM))).reshape(-1, 2 * DIM)
        sizes = [*map(len, at), len(flat)]
        return (np.repeat([0, 1, 2], sizes), np.concatenate([*at, np.arange(len(flat))]),
                np.concatenate([*(m[a] for m, a in zip(self.moved, at)), np.full(len(flat), self.seen)]),
                np.concatenate([*(np.concatenate([e[a], q[a]], axis=1) for e, q, a in zip(self.model.emb, self.model.squares, at)), flat])
                .astype(np.float64))


class Scorer:
    """Scores whole texts; keeps the vectors of the words it has seen."""

    def __init__(self, model: TextCNN):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.vocabulary = Vocabulary()
        self.x = np.zeros((1024, DIM), np.float32)

    def embed(self, words: list[bytes]) -> np.ndarray:
        if len(self.vocabulary.number) > CACHE:
            self.reset()
        known = len(self.vocabulary.number)
        ids, rows = self.vocabulary.ids(words)
        if rows is not None:
            need = known + rows.shape[1]
            if need > len(self.x):
                self.x = np.concatenate([self.x, np.zeros((max(need, len(self.x)), DIM), np.float32)])
            self.x[known:need] = self.model.vectors(rows)
        return self.x[ids]

    def __call__(self, text: bytes) -> tuple[float, int]:
        """(calibrated score, guessed language) of one text of any length."""
        top = np.zeros(len(self.model.out), np.float32)
        votes = np.zeros(len(FUNCTION_WORDS))
        tail: list[bytes] = []
        for chunk in byte_chunks(text, CHUNK):
            new = words_of(chunk)
            votes += self.vocabulary.votes(new)
            seen = tail + new
            whole = len(seen) - PAD             # positions whose windows end inside this chunk
            if whole > 0:
                top = np.maximum(top, self.model.responses(self.embed(seen))[:whole].max(axis=0))
            tail = seen[-PAD:]
        if tail:
            top = np.maximum(top, self.model.responses(self.embed(tail)).max(axis=0))
        return self.verdict(top, votes)

    def verdict(self, top: np.ndarray, votes: np.ndarray) -> tuple[float, int]:
        lang = guess_language(votes)
        return self.model.calibrated(float(self.model.probability(top)), lang), lang

    def many(self, texts: list[bytes]) -> list[tuple[float, int]]:
        """The same for several texts; short ones share the numpy calls."""
        out: list[tuple[float, int]] = [(0.0, 0)] * len(texts)
        held: list[tuple[int, list[bytes]]] = []
        count = 0
        for i, text in enumerate(texts):
            if len(text) > CHUNK:
                out[i] = self(text)
                continue
            held.append((i, words_of(text)))
            count += len(held[-1][1])
            if count > 100_000:
                self.flush(held, out)
                held, count = [], 0
        self.flush(held, out)
        return out

    def flush(self, held: list[tuple[int, list[bytes]]], out: list[tuple[float, int]]) -> None:
        flat: list[bytes] = []
        start = []
        for _, words in held:
            start.append(len(flat))
            flat += words
            flat += [b""] * PAD         # no feature, no vector: filters do not see the next text
        if flat:
            resp = self.model.responses(self.embed(flat))
            ends = np.array([*start[1:], len(flat)], np.int64)
            resp[np.concatenate([ends - k for k in range(1, PAD + 1)])] = 0     # positions behind a text
            tops = np.maximum.reduceat(resp, start, axis=0)
            for (i, words), top in zip(held, tops):
                out[i] = self.verdict(top, self.vocabulary.votes(words))


def best_cut(p: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The threshold with the best F1 (rows count by ``weight``), in the middle of its gap; 0.5 where a class is missing."""
    if not len(y) or y.all() or not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    w = np.ones(len(y)) if weight is None else weight[order]
    q, hit = p[order], np.cumsum(w * y[order])
    f1 = 2 * hit / (np.cumsum(w) + hit[-1])
    f1[:-1][q[:-1] == q[1:]] = -1                       # ties fall on one side
    k = int(f1.argmax())
    low = q[k + 1] if k + 1 < len(q) else 0.0
    return float(np.clip((q[k] + low) / 2, 0.05, 0.95))


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y): every label to learn from, once an id (the larger one).

    Rows whose id's CRC-32 is divisible by 5 are held out and never used.
    """
    return (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
            .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
            .groupBy("doc_id").agg(F.max(label).alias("y")))


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, y) of every row to learn from; there may be as many labels as texts, so none are broadcast."""
    one = training_labels(labels, label).where("y in (0, 1)").select("doc_id", F.col("y").cast("int").alias("y"))
    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).join(one.hint("merge"), "doc_id"))


def dealt(rows: DataFrame, units: int) -> DataFrame:
    """(unit, slice, held, y, words): the words of each text, packed; a unit's rows in hash order in one partition."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            words = [zlib.compress(b" ".join(words_of(t or b"")), 1) for t in as_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), *batch.columns[1:]],
                                             names=["words", *batch.schema.names[1:]])

    mixed = F.xxhash64(F.lit("place"), "doc_id")
    numbered = rows.select("text", "doc_id", "y", F.pmod(F.xxhash64(F.lit("unit"), "doc_id"), F.lit(units)).cast("int").alias("unit"),
                           F.pmod(F.xxhash64(F.lit("slice"), "doc_id"), F.lit(ROUNDS)).cast("int").alias("slice"),
                           (F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(HOLD)) == 0).alias("held"), mixed.alias("place"))
    schema = "words binary, doc_id {}, y int, unit int, slice int, held boolean, place bigint".format(
        rows.schema["doc_id"].dataType.simpleString())
    return (numbered.mapInArrow(run, schema).repartitionById(units, F.col("unit"))
            .sortWithinPartitions("unit", "place", "doc_id", "words").select("unit", "slice", "held", "y", "words"))


def unpacked(column) -> list[bytes]:
    return [zlib.decompress(w) for w in column.to_pylist()]


def live_rows(rows: DataFrame) -> list[np.ndarray]:
    """Rows of both tables whose features are in ``MIN_DF`` texts at least."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        count = DocumentCounts()
        for batch in batches:
            texts = [text.split() for text in unpacked(batch.column(0))]
            for at in range(0, len(texts), BATCH):
                count.add(texts[at:at + BATCH])
        at = [np.flatnonzero(c) for c in count.df]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], list(map(len, at))), pa.int32()), pa.array(np.concatenate(at), pa.int32()),
             pa.array(np.concatenate([c[a] for c, a in zip(count.df, at)]), pa.int64())], names=["t", "row", "n"])

    found = (rows.select("words").mapInArrow(run, "t int, row int, n bigint").groupBy("t", "row")
             .agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_DF).select("t", "row").toArrow())     # 2 * BUCKETS at most
    t, row = (found.column(c).to_numpy() for c in ("t", "row"))
    return [np.sort(row[t == k]) for k in range(2)]


VALUES = [f"v{i}" for i in range(2 * DIM)]


def learned(rows: DataFrame, model: TextCNN, lr: float) -> None:
    """One round: each unit learns from its ``rows``, beginning at ``model``, which becomes their mean."""
    import pyarrow as pa
    held = rows.sparkSession.sparkContext.broadcast(model.state)     # of fixed size at most
    names = ["t", "row", "n", *VALUES]

    def changes(learner: Learner) -> pa.RecordBatch:
        t, row, n, values = learner.changes()
        whole = np.rint(values * n[:, None] * SCALE).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(row, pa.int32()), pa.array(n, pa.int64()),
                                           *(pa.array(c, pa.int64()) for c in whole.T.copy())], names=names)

    def run(batches: Iterator) -> Iterator:
        unit = learner = None
        for batch in batches:
            for u, y, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if u != unit:
                    if learner:
                        yield changes(learner)
                    unit, learner = u, Learner(TextCNN.of(held.value), lr)
                learner.add(zlib.decompress(packed).split(), y)
        if learner:
            yield changes(learner)

    sums = (rows.select("unit", "y", "words")
            .mapInArrow(run, "t int, row int, n bigint, " + ", ".join(f"{c} bigint" for c in VALUES)).groupBy("t", "row")
            .agg(*((F.sum(c) / F.sum("n") / F.lit(float(SCALE))).cast("float").alias(c) for c in VALUES)).orderBy("t", "row").toArrow())
    held.destroy()
    t, row = sums.column("t").to_numpy(), sums.column("row").to_numpy()
    model.put([(row[t == k], np.stack([sums.column(c).to_numpy()[t == k] for c in VALUES], axis=1)) for k in range(3)])


def counted_scores(rows: DataFrame, model: TextCNN) -> tuple[np.ndarray, ...]:
    """(p, language, y, texts): how many of the rows have each score, rounded to ``BINS`` bins."""
    import pyarrow as pa
    held = rows.sparkSession.sparkContext.broadcast(model.state)

    def run(batches: Iterator) -> Iterator:
        scorer = Scorer(TextCNN.of(held.value))
        for batch in batches:
            got = scorer.many(unpacked(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([min(int(p * BINS), BINS - 1) for p, _ in got], pa.int32()), pa.array([g for _, g in got], pa.int32()),
                 batch.column(0)], names=["bin", "language", "y"])

    found = (rows.select("y", "words").mapInArrow(run, "bin int, language int, y int").groupBy("bin", "language", "y")
             .agg(F.count("*").alias("n")).orderBy("bin", "language", "y").toArrow())     # 2 * BINS * languages at most
    held.destroy()
    at, lang, y, n = (found.column(c).to_numpy() for c in ("bin", "language", "y", "n"))
    return (at + 0.5) / BINS, lang, y, n.astype(np.float64)


def rate(done: int) -> float:
    return 0.02 * (1 - done / ROUNDS) + 0.002


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", seed: int = 7) -> TextCNN:
    """The classifier, fitted on every labelled row that is not held out.

    Without labels of both classes nothing is learned: every score is low.
    """
    model = TextCNN(seed)
    source = training_rows(docs, labels, label)
    sizes = dict(source.groupBy("y").count().collect())
    if len(sizes) < 2:
        return model
    n = sum(sizes.values())
    visits = max(1, min(ROUNDS, FEW // n))
    units = max(1, min(UNITS, round(n * (HOLD - 1) / HOLD * visits / ROUNDS / UNIT)))
    rows = written(dealt(source, units), "toxicity-rows")
    model.begin(live_rows(rows))
    for done in range(ROUNDS):
        now = [(done + i) % ROUNDS for i in range(visits)]
        learned(rows.where(~F.col("held") & F.col("slice").isin(now)), model, rate(done))
    p, lang, y, weight = counted_scores(rows.where("held"), model)
    learned(rows.where("held"), model, rate(ROUNDS))
    model.calibrate(p, lang, y, weight=weight)
    return model


def words_cut(sizes: list[tuple[int, int, int]], most: int | None = None) -> dict[int, int]:
    """Last order kept of each class, from sorted (class, order, words): ``most`` words, shared between the classes.

    For callers that pick rows for :func:`train_on`; :func:`train` leaves out none.
    """
    most = SAMPLE_WORDS if most is None else most
    total = {c: sum(n for k, _, n in sizes if k == c) for c in (0, 1)}
    last = {}
    for c in (0, 1):
        own = [(o, n) for k, o, n in sizes if k == c]
        fits = int((np.cumsum([n for _, n in own]) <= max(most // 2, most - total[1 - c])).sum())
        if fits:
            last[c] = own[fits - 1][0]
    return last


def train_on(texts: list[list[bytes]], y: np.ndarray, seed: int = 7, weight: np.ndarray | None = None) -> TextCNN:
    """The same in one process, on the words of some texts and their 0/1 labels; the thresholds count a text by its ``weight``."""
    model = TextCNN(seed)
    if not len(y) or y.all() or not y.any():
        return model
    count = DocumentCounts()
    count.add(texts)
    model.begin([np.flatnonzero(c >= MIN_DF) for c in count.df])
    held = np.arange(len(y)) % HOLD == 0
    scores = None
    for done in range(ROUNDS + 1):
        if done == ROUNDS:
            scores = list(zip(*Scorer(model).many([b" ".join(t) for t, h in zip(texts, held) if h])))
        learner = Learner(model, rate(done))
        for i in model.rng.permutation(np.flatnonzero(held if scores else ~held)):
            learner.add(texts[i], int(y[i]))
        learner.changes()
    model.calibrate(np.array(scores[0]), np.array(scores[1]), y[held], weight=None if weight is None else weight[held])
    return model


def score(docs: DataFrame, model: TextCNN, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all others), ``score`` (0.5 is the language's threshold) and ``language``.

    Null and empty texts have the score of a text without words. Rows are
    scored one by one: repeated rows give equal scores, and an empty table
    gives an empty result.
    """
    import pyarrow as pa
    carry = carry if carry is not None else [c for c in docs.columns if c not in ("score", "language")]
    src = docs.select(*(F.col(f"`{c}`") for c in carry), F.col(text).cast("string").alias("_text"))
    schema = src.drop("_text").withColumns({"score": F.lit(0.0), "language": F.lit("")}).schema
    state = (model.emb, model.conv, model.bias, model.out, model.out0, model.cut)   # fixed size
    held = docs.sparkSession.sparkContext.broadcast(state)
    n = len(carry)

    def run(batches: Iterator) -> Iterator:
        m = TextCNN.__new__(TextCNN)
        m.emb, m.conv, m.bias, m.out, m.out0, m.cut = held.value
        scorer = Scorer(m)
        for batch in batches:
            got = scorer.many([t or b"" for t in as_bytes(batch.column(n))])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(n)), pa.array([p for p, _ in got], pa.float64()),
                 pa.array([LANGUAGES[g] for _, g in got], pa.string())], names=[*carry, "score", "language"])

    return src.mapInArrow(run, schema)
