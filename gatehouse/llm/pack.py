"""Packing by concatenate and cut.

The tokens of all documents, in the order of the table's partitions, are one
long run that is cut into windows. Two passes of prefix sums give each
document its place there: a running sum inside each partition while it is
tokenised, then a running sum over the partitions' totals. A window's border
may fall into a document; each part of a document is one row of the result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatehouse.llm.common import Kept, cut_words, written

WORDS = 450_000         # words, and
PIECES = 20_000         # other pieces of a generation kept in a Python worker
MARKS = frozenset(",.;:!?")    # a piece of their own behind letters
ROWS = 256              # texts of a batch held as Python strings
MADE = ("doc_tokens", "start", "length", "ids", "sequence_id", "offset")


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: itself
    where it is printable in Latin-1, else the next free letter from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class Tokeniser:
    """Ids (little-endian 32 bits each) of whole texts by a byte-level tokenizer file, word by word."""

    def __init__(self, data: str, pattern: str):
        import regex
        from tokenizers import Tokenizer
        self.model, self.find, self.letters = Tokenizer.from_str(data).model.tokenize, regex.compile(pattern).findall, byte_letters()
        self.blank = self.letters[0x20]
        self.pieces, self.words = Kept(self.piece, PIECES), Kept(self.word, WORDS)

    def piece(self, p: str) -> bytes:
        """One piece of the pattern, by the library's model."""
        shown = self.blank + p[1:] if p[0] == " " and p[1:].isalnum() and p.isascii() else p.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model(shown)]).tobytes()

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

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        first, rest = cut_words(text)
        opening = self.text(first) if first else b""
        return opening + b"".join(map(self.words.__getitem__, rest))


def tokenise(docs: DataFrame, path: str, pattern: str, text: str = "text", end_id: int = 0,
             carry: list[str] | None = None) -> DataFrame:
    """``row``, a struct of the ``carry`` columns, ``ids`` (little-endian 32 bits each,
    ``end_id`` last), ``doc_tokens``, the partition ``part`` and ``before``, the
    tokens before the document in its partition.

    Special tokens are ordinary text. Null and empty texts have ``end_id`` alone.
    """
    import pyarrow as pa
    carry = carry if carry is not None else [c for c in docs.columns if c not in (text, *MADE)]
    src = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry), F.lit(0).alias("")).alias("row"),
                      F.col(f"`{text}`").cast("string").alias("text"))
    schema = (src.select("row").withColumn("ids", F.lit(None).cast("binary"))
              .withColumn("doc_tokens", F.lit(None).cast("bigint")).withColumn("before", F.lit(None).cast("bigint")).schema)
    with open(path, encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast({"file": f.read()})     # one fixed file
    last = array("I", [end_id]).tobytes()

    def run(batches: Iterator) -> Iterator:
        mine = held.value               # a worker has one for all its tasks, and with it the words it has met
        if "tokeniser" not in mine:
            mine["tokeniser"] = Tokeniser(mine["file"], pattern)
        ids_of, before = mine["tokeniser"], 0
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                some = batch.slice(at, ROWS)
                ids = [ids_of(t or "") + last for t in some.column(1).to_pylist()]
                sizes = [len(x) // 4 for x in ids]
                places = []
                for n in sizes:
                    places.append(before)
                    before += n
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(places, pa.int64())],
                    names=["row", "ids", "doc_tokens", "before"])

    return src.mapInArrow(run, schema).withColumn("part", F.spark_partition_id())


def tail_cuts(total: int, length: int) -> list[int]:
    """Borders of the windows behind the last whole one: the rest as falling powers of two, none padded."""
    at, out = total - total % length, []
    while at < total:
        at += 1 << ((total - at).bit_length() - 1)
        out.append(at)
    return out


def pack(docs: DataFrame, path: str, pattern: str, length: int = 1024, text: str = "text", end_id: int = 0,
         carry: list[str] | None = None) -> DataFrame:
    """One row a piece of a document: ``carry`` columns (default: all but the text),
    ``start`` (the document's ids before it), ``length``, ``ids`` (little-endian 32
    bits each), ``doc_tokens``, ``sequence_id`` and ``offset`` (its place there).

    Sequences hold exactly ``length`` ids; what is left at the very end makes
    sequences of falling powers of two, so nothing is padded. A null or empty
    text is the document of ``end_id`` alone; repeated rows are documents of
    their own; an empty table gives an empty result. Columns of the names made
    here are replaced. Two runs may order documents differently only if the
    table's partitions do.
    """
    spark = docs.sparkSession
    rows = written(tokenise(docs, path, pattern, text, end_id, carry), "pack-tokens")
    totals = rows.groupBy("part").agg(F.sum("doc_tokens").alias("n"))           # one row a partition
    total = totals.agg(F.sum("n")).first()[0] or 0
    bases = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    whole, tail = total - total % length, F.array(*(F.lit(c).cast("bigint") for c in tail_cuts(total, length)))

    at, end = F.col("at"), F.col("at") + F.col("doc_tokens")

    def below(x: Column, step: int) -> Column:
        return x - F.pmod(x, F.lit(step))

    def piece(c: Column) -> Column:
        """The piece from the place ``c`` to the next border or the document's end."""
        later = F.filter(tail, lambda b: b > c)
        opened = F.coalesce(F.array_max(F.filter(tail, lambda b: b <= c)), F.lit(whole).cast("bigint"))
        in_whole = c < whole
        n = F.least(end, F.when(in_whole, below(c, length) + length).otherwise(F.array_min(later))) - c
        start = c - at
        return F.struct(
            start.alias("start"), n.alias("length"),
            F.substring(F.col("ids"), (start * 4 + 1).cast("int"), (n * 4).cast("int")).alias("ids"),
            F.when(in_whole, (below(c, length) / length).cast("bigint"))
             .otherwise(whole // length + F.size(tail) - F.size(later)).cast("bigint").alias("sequence_id"),
            (c - F.when(in_whole, below(c, length)).otherwise(opened)).alias("offset"))

    low, high = below(at, length) + length, F.least(below(end - 1, length), F.lit(whole))
    inside = F.when(low <= high, F.sequence(low, high, F.lit(length).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    starts = F.concat(F.array(at), inside, F.filter(tail, lambda b: (b > at) & (b < end)))
    placed = rows.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("before"))
    cut = placed.select("row", "doc_tokens", F.transform(starts, piece).alias("pieces"))
    kept = [c for c in rows.schema["row"].dataType.names if c]
    return (cut.select("row", "doc_tokens", F.inline("pieces"))
            .select(*(F.col("row").getField(c).alias(c) for c in kept), *MADE))


def sequences(pieces: DataFrame, length: int = 1024, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_tokens) of ``pack``'s pieces: each sequence whole, padded
    with ``pad_id`` to ``length`` unless its size is a power of two. A group has at
    most ``length`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    one = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
    even = F.bit_count("n_tokens") == 1
    return one.select("sequence_id", F.when(even, F.col("ids")).otherwise(
        F.rpad("ids", F.lit(4 * length), F.lit(array("I", [pad_id]).tobytes()))).alias("ids"), "n_tokens")
