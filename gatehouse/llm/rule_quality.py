"""Quality classifier: a sparse ensemble of rules over text statistics.

The statistics are computed over whole texts, in chunks of bounded size. On a bounded
sample of labelled rows (at most ``SAMPLE`` of each class, in hash order; only
their statistics reach the driver) small trees are grown on the residuals of
those before them; every path from a root to a node is a conjunctive rule. A
lasso logistic regression over the rules and the clipped statistics keeps few
of them. What is kept is compiled into one Spark column expression, so
the model itself runs inside the query plan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehouse.llm.common import as_bytes, byte_chunks

SAMPLE = 4000           # labelled rows of each class, at most
TREES = 40
DEPTH = 3
SHRINK = 0.3
MIN_LEAF = 8
CUTS = 24               # thresholds tried for a statistic
PENALTY = 0.004

NAMES = ("chars", "words", "word_chars", "distinct_words", "repeats", "lines", "distinct_lines", "line_words",
         "upper", "digits", "marks", "stops")

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"#$%&*|{}<>@^~=+_/!"
_STOPS = b".,;:?"
_INNER = bytes(range(128, 192))     # bytes of a character behind its first
CHUNK = 1 << 20


def text_statistics(text: bytes) -> tuple[float, ...]:
    """The statistics named in ``NAMES`` of a whole text, read in chunks."""
    words = repeats = 0
    seen: set[bytes] = set()
    tail = None
    for chunk in byte_chunks(text, CHUNK):
        ws = chunk.split()
        if not ws:
            continue
        repeats += sum(map(eq, ws, ws[1:])) + (ws[0] == tail)
        tail = ws[-1]
        words += len(ws)
        seen.update(ws)
    size = len(text)
    inner = size - len(text.translate(None, _INNER))
    chars = size - inner
    lines = text.split(b"\n")

    def share(some: bytes, of: int) -> float:
        return (size - len(text.translate(None, some))) / max(1, of)

    return (chars, words, chars / max(1, words), len(seen) / max(1, words), repeats / max(1, words),
            len(lines), len(set(lines)) / len(lines), words / len(lines), share(_UPPER, chars),
            share(_DIGITS, chars), share(_MARKS, chars), share(_STOPS, words))


def statistics(df: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``carry`` columns and one double column for each statistic of the whole text (null: empty)."""
    import pyarrow as pa
    src = df.select(*(F.col(f"`{c}`") for c in carry), F.col(text).cast("string").alias("_text"))
    schema = src.drop("_text").withColumns({n: F.lit(0.0) for n in NAMES}).schema
    n = len(carry)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = [text_statistics(t or b"") for t in as_bytes(batch.column(n))]
            values = [pa.array(map(float, v), pa.float64()) for v in zip(*rows)] if rows else [pa.array([], pa.float64())] * len(NAMES)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), *values], names=[*carry, *NAMES])

    return src.mapInArrow(run, schema)


# ---------------------------------------------------------------- rules

@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above?, threshold)."""
    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        ok = np.ones(len(x), bool)
        for j, above, t in self.terms:
            ok &= (x[:, j] > t) if above else (x[:, j] <= t)
        return ok

    def column(self) -> Column:
        out = None
        for j, above, t in self.terms:
            c = F.col(NAMES[j]) > t if above else F.col(NAMES[j]) <= t
            out = c if out is None else out & c
        return out.cast("double")


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], depth: int,
         path: tuple = ()) -> list[tuple[tuple, np.ndarray, float]]:
    """(path, rows, value) of the leaves; every prefix of a path is a rule."""
    value = -g.sum() / (h.sum() + 1.0)
    best = (1e-6, None)
    if depth:
        base = g.sum() ** 2 / (h.sum() + 1.0)
        for j, ts in enumerate(cuts):
            for t in ts:
                left = x[:, j] <= t
                n = int(left.sum())
                if n < MIN_LEAF or len(x) - n < MIN_LEAF:
                    continue
                gl, hl = g[left].sum(), h[left].sum()
                gain = gl ** 2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - base
                if gain > best[0]:
                    best = (gain, (j, float(t), left))
    if best[1] is None:
        return [(path, np.arange(len(x)), value)]
    j, t, left = best[1]
    out = []
    for above, side in ((False, left), (True, ~left)):
        rows = np.flatnonzero(side)
        out += [(p, rows[r], v) for p, r, v in grow(x[rows], g[rows], h[rows], cuts, depth - 1, path + ((j, above, t),))]
    return out


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The distinct rules of ``TREES`` boosted trees."""
    z = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    found: dict[tuple, None] = {}
    rng = np.random.default_rng(11)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        part = rng.random(len(y)) < 0.7         # each tree sees other rows and other thresholds
        cuts = [np.unique(np.quantile(x[part, j], rng.random(CUTS))) for j in range(x.shape[1])]
        for path, _, value in grow(x[part], (p - y)[part], (p * (1 - p))[part], cuts, DEPTH):
            for k in range(1, len(path) + 1):
                found[tuple(sorted(path[:k]))] = None
            z += SHRINK * value * Rule(path).holds(x) if path else 0
    return [Rule(t) for t in found]


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L1-penalised logistic regression (accelerated proximal gradient)."""
    n, k = a.shape
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    v, vb, s = w.copy(), b, 1.0
    size = np.linalg.norm(np.column_stack([a, np.ones(n)]), 2) ** 2 / (4 * n)
    for _ in range(steps):
        r = 1 / (1 + np.exp(-np.clip(a @ v + vb, -30, 30))) - y
        nw = v - a.T @ r / n / size
        nw = np.sign(nw) * np.maximum(np.abs(nw) - penalty / size, 0)
        nb = vb - r.mean() / size
        ns = (1 + np.sqrt(1 + 4 * s * s)) / 2
        v, vb = nw + (s - 1) / ns * (nw - w), nb + (s - 1) / ns * (nb - b)
        w, b, s = nw, nb, ns
    return w, b


@dataclass
class RuleEnsemble:
    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)
    linear: list[tuple[int, float, float, float, float]] = field(default_factory=list)  # j, low, high, scale, weight

    def logit(self) -> Column:
        out = F.lit(self.intercept)
        for rule, w in self.rules:
            out = out + rule.column() * w
        for j, low, high, scale, w in self.linear:
            out = out + F.greatest(F.lit(low), F.least(F.lit(high), F.col(NAMES[j]))) * (w / scale)
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for rule, w in self.rules:
            out += w * rule.holds(x)
        for j, low, high, scale, w in self.linear:
            out += np.clip(x[:, j], low, high) * (w / scale)
        return out


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> RuleEnsemble:
    """The ensemble for statistics ``x`` and 0/1 labels; with one class only, its rate."""
    if not len(y) or y.all() or not y.any():
        rate = (float(y.sum()) + 0.5) / (len(y) + 1)
        return RuleEnsemble(float(np.log(rate / (1 - rate))))
    rules = tree_rules(x, y)
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    lin = np.clip(x, low, high)
    scale = np.maximum(lin.std(axis=0), 1e-9) / 0.4           # as strong as a typical rule
    a = np.column_stack([np.column_stack([r.holds(x) for r in rules]).astype(float) if rules else np.zeros((len(x), 0)), lin / scale])
    keep = a.std(axis=0) > 0
    w = np.zeros(a.shape[1])
    w[keep], b = lasso_logistic(a[:, keep], y, penalty)
    return RuleEnsemble(b, [(r, float(c)) for r, c in zip(rules, w) if c],
                        [(j, float(low[j]), float(high[j]), float(scale[j]), float(c))
                         for j, c in enumerate(w[len(rules):]) if c])


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y): every label to learn from, once an id (the larger one).

    Rows whose id's CRC-32 is divisible by 5 are held out and never used.
    """
    return (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
            .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
            .groupBy("doc_id").agg(F.max(label).alias("y")))


def labelled_statistics(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE) -> DataFrame:
    """(y, order, statistics) of at most ``rows`` labelled rows of each class, in hash order."""
    one = training_labels(labels, label).withColumn("order", F.xxhash64(F.lit("sample"), "doc_id"))
    picked = None
    for c in (0, 1):
        part = one.where(F.col("y") == c).orderBy("order", "doc_id").limit(rows)
        picked = part if picked is None else picked.unionByName(part)
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")      # 2 * rows ids at most
    return statistics(chosen, "text", ["y", "order"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE) -> RuleEnsemble:
    """Fit on the bounded sample; the classes keep their shares among all training labels.

    A class that the sample cuts is given its share back in the intercept: the
    log-odds move by the logarithm of full count / sampled count.
    """
    got = sorted(tuple(r) for r in labelled_statistics(docs, labels, label, rows).collect())     # numbers only
    if not got:
        return RuleEnsemble()
    data = np.array(got, np.float64)
    y = data[:, 0]
    model = fit(data[:, 2:], y)
    if y.any() and not y.all():
        full = dict(training_labels(labels, label).where("y in (0, 1)").groupBy("y").agg(F.count("*")).collect())
        model.intercept += float(np.log(full[1] / min(full[1], rows)) - np.log(full[0] / min(full[0], rows)))
    return model


def score(docs: DataFrame, model: RuleEnsemble, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all others) and ``score``, the probability of label 1.

    Null and empty texts have the score of a text without words; repeated rows
    give equal scores; an empty table gives an empty result.
    """
    carry = carry if carry is not None else [c for c in docs.columns if c != "score"]
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("_row"), F.col(text).alias("_text"))
    stats = statistics(packed, "_text", ["_row"])
    return stats.select("_row.*", (1 / (1 + F.exp(-model.logit()))).alias("score"))
