"""Secret scan: fixed patterns, plus strings that pass a randomness test battery.

Base kinds (assign, access, hex) are found by their patterns. The battery adds
the kind ``random``: runs of key characters are cut at base spans, ``=`` and ``.``,
and every piece of 20 or more characters that one alphabet holds, and every such
stretch of letters and digits in it, gets an inferred encoding, and three tests of
the hypothesis that its characters are drawn uniformly and independently from that alphabet:

* chi-squared: are the alphabet's symbols, and its digits, capitals and small
  letters, as frequent as they should be;
* runs: does the sequence of "above / below the alphabet's middle" have the
  expected number of runs;
* serial correlation: are neighbouring symbol values uncorrelated.

Fisher's method combines the three p-values. Ordinary words get p near zero;
random strings get p spread evenly over 0..1. So, for each length class and
encoding, the strings above p = 1/2 tell how many random ones there are, and
at a cut ``t`` the share of ordinary ones among those kept is
``1 - (1 - t) * 2 * #(p > 1/2) / #(p >= t)``. The smallest cut whose share is
at most ``fdr`` is used (length-aware false-discovery control). A class whose
evidence is too thin for that (fewer than ``MIN_CLASS`` distinct strings above
1/2) uses the fixed cut ``THIN_CUT``. The counts run over the distinct strings of
all documents, as a Spark aggregate; only the cuts, of which there are at most
``len(ENCODINGS) * len(LENGTHS)``, reach the driver.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatehouse.llm.common import written

# The base patterns.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KEYWORDS = ("password", "passwd", "secret", "token", "api")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX, MIN_RUN = 6, 20, 24, 20
KINDS = ("assign", "access", "hex", "random")

# Alphabets of the encodings a key may be written in, narrowest first.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "upper36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "alnum62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
LENGTHS = (20, 24, 32, 40, 64, 128)      # lower ends of the length classes
BINS = 200                               # resolution of the cuts
MIN_CLASS = 20
THIN_CUT = 0.2
FDR = 0.05

SPANS = "array<struct<kind:int,start:bigint,end:bigint>>"
FOUND = "array<struct<start:bigint,end:bigint,enc:string,len_class:int,p:double,h:bigint,outer:array<struct<enc:string,len_class:int,p:double>>>>"


# ---------------------------------------------------------------- the battery

def _normal_tail(z: float) -> float:
    """Two-sided p-value of a standard normal deviate."""
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail of the chi-squared law (Wilson-Hilferty; exact for even df up to 6)."""
    if df in (2, 4, 6):
        half = x / 2
        return math.exp(-half) * sum(half ** k / math.factorial(k) for k in range(df // 2))
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _binomial_tail(x: int, n: int, p: float) -> float:
    """Two-sided p-value of ``x`` successes in ``n`` trials (twice the smaller tail)."""
    if n > 400:
        return _normal_tail((x - n * p) / math.sqrt(n * p * (1 - p)))
    weight = [math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(n + 1)]
    return min(1.0, 2 * min(sum(weight[:x + 1]), sum(weight[x:])))


def encoding_of(s: str) -> str | None:
    """The narrowest alphabet that holds all of ``s`` (padding ``=`` aside)."""
    seen = set(s.rstrip("="))
    for name, alphabet in ENCODINGS.items():
        if seen <= set(alphabet):
            return name
    return None


def battery(s: str, encoding: str) -> float:
    """Combined p-value of the hypothesis that ``s`` is uniform random text."""
    alphabet = ENCODINGS[encoding]
    value = {c: i for i, c in enumerate(alphabet)}
    x = [value[c] for c in s.rstrip("=") if c in value]
    n, k = len(x), len(alphabet)
    if n < 8:
        return 0.0
    # chi-squared over cells of neighbouring symbols, five or more expected in each
    cells = max(2, min(k, n // 5))
    count = [0] * cells
    share = [0] * cells
    for v in range(k):
        share[v * cells // k] += 1
    for v in x:
        count[v * cells // k] += 1
    chi = sum((c - n * w / k) ** 2 / (n * w / k) for c, w in zip(count, share))
    p_chi = _chi2_tail(chi, cells - 1)
    # repeated symbols: the whole alphabet, by its collision count (normal limit)
    full = [0] * k
    for v in x:
        full[v] += 1
    pairs = sum(c * (c - 1) // 2 for c in full)
    mean = n * (n - 1) / 2 / k
    p_pairs = 0.5 * math.erfc((pairs - mean) / math.sqrt(mean * (1 - 1 / k)) / math.sqrt(2))
    # digits, capitals and small letters: each as frequent as in the alphabet
    text = s.rstrip("=")
    p_class = 1.0
    for part in ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"):
        share_of = sum(c in alphabet for c in part) / k
        if 0 < share_of < 1:
            p_class = min(p_class, _binomial_tail(sum(c in part for c in text), n, share_of))
    p_chi = min(1.0, 3 * min(p_chi, p_pairs, p_class))
    # runs about the middle of the alphabet
    up = [2 * v >= k for v in x]
    a = sum(up)
    b = n - a
    if a and b:
        runs = 1 + sum(u != v for u, v in zip(up, up[1:]))
        mu = 1 + 2 * a * b / n
        var = (mu - 1) * (mu - 2) / (n - 1)
        p_runs = _normal_tail((runs - mu) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 0.0
    # lag-one serial correlation
    m = sum(x) / n
    ss = sum((v - m) ** 2 for v in x)
    p_serial = 0.0
    if ss:
        r = sum((u - m) * (v - m) for u, v in zip(x, x[1:])) / ss
        p_serial = _normal_tail((r + 1 / n) * math.sqrt(n))
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    return _chi2_tail(fisher, 6)


# ---------------------------------------------------------------- spans of one text

def base_spans(text: str, patterns) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base kinds, in code points."""
    assign, access, hexa, run = patterns
    out = []
    low = text.lower()
    if any(w in low for w in KEYWORDS):
        out += [(0, m.start(), m.end()) for m in assign.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    for r in run.finditer(text):        # both kinds lie inside a run of 20 key characters
        s, off = r.group(), r.start()
        if "AKIA" in s:
            out += [(1, off + m.start(), off + m.end()) for m in access.finditer(s)
                    if m.end() - m.start() >= MIN_ACCESS]
        out += [(2, off + m.start(), off + m.end()) for m in hexa.finditer(s) if m.end() - m.start() >= MIN_HEX]
    return sorted(out, key=lambda t: (t[1], t[0]))


_PART, _BASE64, _URL, _ALNUM = (re.compile("[%s]{%d,}" % (c, MIN_RUN)) for c in (
    "A-Za-z0-9+/_-", "A-Za-z0-9+/", "A-Za-z0-9_-", "A-Za-z0-9"))


def pieces(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Parts of ``text[start:end]`` of ``MIN_RUN`` or more characters that one alphabet holds.

    ``=`` and ``.`` end a part. One that no alphabet holds, as it has ``+`` or ``/``
    besides ``-`` or ``_``, is cut at either pair. Stretches of letters and
    digits alone follow the longer pieces they lie in: a path or a name may
    stand before a key.
    """
    for m in _PART.finditer(text, start, end):
        s, e = m.span()
        found = {(s, e)} if encoding_of(text[s:e]) else {r.span() for kind in (_BASE64, _URL) for r in kind.finditer(text, s, e)}
        found |= {r.span() for r in _ALNUM.finditer(text, s, e)}
        out = set()
        for s, e in found:
            while e > s and text[e - 1] in "-_/":        # closing punctuation is no part of a key
                e -= 1
            if e - s >= MIN_RUN:
                out.add((s, e))
        yield from sorted(out, key=lambda t: (t[0], -t[1]))


def candidates(text: str, base: list[tuple[int, int, int]], run) -> Iterator[tuple[int, int]]:
    """Pieces of the runs of key characters, outside the base spans."""
    at, n = 0, len(base)
    for r in run.finditer(text):
        s, e = r.span()
        while at < n and base[at][2] <= s:
            at += 1
        i = at
        while i < n and base[i][1] < e:
            if base[i][1] > s:
                yield from pieces(text, s, base[i][1])
            s = max(s, base[i][2])
            i += 1
        if s < e:
            yield from pieces(text, s, e)


def tested(text: str, base: list[tuple[int, int, int]], run) -> list[dict]:
    """The candidates with their encoding, length class, p-value and hash; ``outer``: the tests of those around one."""
    from xxhash import xxh64_intdigest
    out, around = [], []
    for s, e in candidates(text, base, run):
        enc = encoding_of(text[s:e])
        around = [a for a in around if a["end"] > s]     # at most a few: pieces overlap only within a part
        one = {"start": s, "end": e, "enc": enc, "len_class": max(x for x in LENGTHS if x <= e - s),
               "p": battery(text[s:e], enc), "h": xxh64_intdigest(text[s:e].encode()) - (1 << 63),
               "outer": [{k: a[k] for k in ("enc", "len_class", "p")} for a in around if a["end"] >= e]}
        around.append(one)
        out.append(one)
    return out


def scan(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns, ``base`` spans and ``cand`` (battery candidates) of every row."""
    import pyarrow as pa
    carry = carry if carry is not None else [c for c in docs.columns if c not in (text, "base", "cand", "spans")]
    src = docs.select(*(F.col(f"`{c}`") for c in carry), F.col(text).cast("string").alias("_text"))
    schema = (src.select(*(F.col(f"`{c}`") for c in carry))
              .withColumn("base", F.lit(None).cast(SPANS)).withColumn("cand", F.lit(None).cast(FOUND)).schema)
    n = len(carry)
    span_t = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    cand_t = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("enc", pa.string()),
                                 ("len_class", pa.int32()), ("p", pa.float64()), ("h", pa.int64()),
                                 ("outer", pa.list_(pa.struct([("enc", pa.string()), ("len_class", pa.int32()), ("p", pa.float64())])))]))

    def run(batches: Iterator) -> Iterator:
        pats = (re.compile(ASSIGN, re.I | re.A), re.compile(ACCESS), re.compile(HEX),
                re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_RUN))
        for batch in batches:
            base, cand = [], []
            for t in batch.column(n).to_pylist():
                t = t or ""
                b = base_spans(t, pats)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in b])
                cand.append(tested(t, b, pats[3]))
            cols = [batch.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(base, span_t), pa.array(cand, cand_t)],
                                             names=[*carry, "base", "cand"])

    return src.mapInArrow(run, schema)


def cuts(found: DataFrame, fdr: float = FDR) -> DataFrame:
    """(enc, len_class, cut): smallest p-value kept, from ``found`` (enc, len_class, p, h)."""
    one = found.groupBy("enc", "len_class", "h").agg(F.max("p").alias("p"))
    binned = (one.withColumn("bin", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)))
              .groupBy("enc", "len_class", "bin").count())
    cls = Window.partitionBy("enc", "len_class")
    above = cls.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)   # at most BINS rows
    upper = F.sum(F.when(F.col("bin") >= BINS // 2, F.col("count")).otherwise(0)).over(cls)
    t = F.col("bin") / BINS
    share = 1 - F.least(F.lit(1.0), (1 - t) * 2 * upper / F.sum("count").over(above))
    ok = (share <= fdr) & (upper >= MIN_CLASS)
    return (binned.withColumn("t", F.when(ok, t)).groupBy("enc", "len_class")
            .agg(F.coalesce(F.min("t"), F.lit(THIN_CUT)).alias("cut")))


def find_secrets(docs: DataFrame, text: str = "text", fdr: float = FDR,
                 carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all but the text), ``base`` and ``spans``: arrays of
    (kind, start, end) in code points ordered by start, then kind as in ``KINDS``;
    ``spans`` holds the base ones and those of the battery. Columns of these
    names in ``docs`` are replaced.

    Null and empty texts have no spans; repeated rows give repeated results;
    an empty table gives an empty result. Base spans are never withdrawn.
    """
    rows = written(scan(docs, text, carry), "secrets-scan")
    found = rows.select(F.explode("cand").alias("c")).select("c.enc", "c.len_class", "c.p", "c.h")
    # at most len(ENCODINGS) * len(LENGTHS) rows: they become part of the expression
    table = sorted(tuple(r) for r in cuts(found, fdr).select("enc", "len_class", "cut").collect())

    def random(c: Column) -> Column:
        cut = F.lit(THIN_CUT)
        for enc, length, value in table:
            cut = F.when((c["enc"] == enc) & (c["len_class"] == length), value).otherwise(cut)
        return c["p"] >= cut

    kept = F.filter("cand", lambda c: random(c) & ~F.exists(c["outer"], random))    # the longest that pass
    added = F.transform(kept, lambda c: F.struct(F.lit(3).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    order = F.array_sort(F.transform(F.concat("base", added), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return rows.select(*(c for c in rows.columns if c not in ("base", "cand")), "base", order.alias("spans"))


def count_of(spans: str, kind: int) -> Column:
    """How many spans are of ``kind``, an index into ``KINDS``."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", fdr: float = FDR, mask: str = "[SECRET]") -> DataFrame:
    """``docs``, same columns, with every secret span replaced by ``mask``.

    Overlapping spans are masked once. Rows without secrets come out as they were.
    """
    import pyarrow as pa
    names = docs.columns
    at = names.index(text)
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(text).alias("_text"))
    found = find_secrets(packed, "_text", fdr, carry=["row"])
    flat = found.select(*(F.col("row").getField(c).alias(c) for c in names), F.col("spans").alias("_spans"))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            out = []
            for t, spans in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                if t and spans:
                    parts, end = [], 0
                    for s in spans:
                        if s["end"] <= end:
                            continue
                        if s["start"] >= end:
                            parts += [t[end:s["start"]], mask]
                        end = s["end"]
                    t = "".join([*parts, t[end:]])
                out.append(t)
            cols = [batch.column(i) for i in range(len(names))]
            cols[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return flat.mapInArrow(run, docs.schema)
