import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from gatehouse.llm import pack
from gatehouse.llm.queries import QUERIES
from tests.llm.frames import LONG, docs

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tokeniser():
    return pack.Tokeniser(open(PATH, encoding="utf-8").read(), P.PATTERN)


def unpack(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


TEXTS = ["", " ", "  ", "   ", " a", "a ", "a  ", "a  b", "a   b", "a \n b", "a\n \nb", "a\n b", "\n\n x\t y  \r\n", "it's we'll I'D",
         "x" * 3000, " " * 500 + "end", "\x1c a \x1d b", "naïve Übergröße 東京 日本語 🙂🙂", "1234567 3.14 a1b2", "end. Mid, last?!",
         "<|endoftext|> is text<|endoftext|>", "a\x85b \x85 c", "tab\tsep \t x", "word: other; word.\nNew", "é ́ x"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_as_the_library(reference, tokeniser, text):
    assert unpack(tokeniser(text)) == reference(text)


def test_random_ids_as_the_library(reference, tokeniser):
    r = random.Random(5)
    for _ in range(1500):
        alphabet = r.choice(["ab ", "the aeiou \n", "0123 -.", "éüß ñ\t", "a'stl ", "日本 語🙂", " \n\t\r\x1c\x85 a", "  　x."])
        text = "".join(r.choices(alphabet, k=r.randint(0, 60)))
        assert unpack(tokeniser(text)) == reference(text), repr(text)


def test_small_caches_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(pack, "WORDS", 3)
    monkeypatch.setattr(pack, "PIECES", 2)
    t = pack.Tokeniser(open(PATH, encoding="utf-8").read(), P.PATTERN)
    for text in ("one two, three four. five two, six one", "six one two, ten", "one two one two\ttwo"):
        assert unpack(t(text)) == reference(text)


def whole(pieces, wanted, length=1024):
    """Checks that the pieces are ``wanted`` (key to list of id lists) and returns sequence sizes."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length * 4 == len(p.ids) and p.length > 0
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    got = {}
    for key, ps in by_doc.items():
        texts, total = [], ps[0].doc_tokens
        for p in sorted(ps, key=lambda p: (p.sequence_id, p.offset)):
            assert p.start + p.length <= p.doc_tokens
            if p.start == 0:
                texts.append([])
            texts[-1] += unpack(p.ids)
        got[key] = sorted(texts)
        assert total in {len(t) for t in texts}
    assert got == {k: sorted(v) for k, v in wanted.items()}
    sizes = {}
    for s, ps in by_seq.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        sizes[s] = at
    assert sorted(sizes) == list(range(len(sizes))) and all(n <= length for n in sizes.values())
    assert all(n == length or n & (n - 1) == 0 for n in sizes.values())         # nothing is padded
    return sizes


def test_every_id_in_one_piece(spark, reference):
    rows = [(1, "a b c"), (2, None), (3, ""), (4, LONG[:90_000]), (5, "same text"), (5, "same text"), (None, "no id"), (6, "x " * 3000)]
    wanted = defaultdict(list)
    for d, t in rows:
        wanted[d].append(reference(t) + [0])
    df = docs(spark, rows).withColumnsRenamed({"fp": "start", "size": "sequence_id", "shard": "part", "n_chars": "row"}).repartition(3)
    got = pack.pack(df, PATH, P.PATTERN)
    assert set(got.columns) == {"doc_id", "lang", "source", "row", "source_size", "doc_tokens", "start", "length", "ids",
                                "sequence_id", "offset", "part"}
    pieces = got.collect()
    sizes = whole(pieces, wanted)
    assert sum(sizes.values()) == sum(len(t) for ts in wanted.values() for t in ts)


@pytest.mark.parametrize("length", [1, 2, 7, 64])
def test_other_lengths(spark, reference, length):
    rows = [(i, "lorem ipsum dolor " * (i % 5)) for i in range(20)]
    pieces = pack.pack(docs(spark, rows).repartition(4), PATH, P.PATTERN, length=length, carry=["doc_id"])
    kept = pieces.collect()
    whole(kept, {i: [reference(t) + [0]] for i, t in rows}, length)
    seqs = {r.sequence_id: r for r in pack.sequences(pieces, length, pad_id=9).collect()}
    for s, r in seqs.items():
        ids = [i for p in sorted((p for p in kept if p.sequence_id == s), key=lambda p: p.offset) for i in unpack(p.ids)]
        even = len(ids) & (len(ids) - 1) == 0
        assert r.n_tokens == len(ids) and unpack(r.ids) == (ids if even else ids + [9] * (length - len(ids)))


def test_empty_table(spark):
    got = pack.pack(docs(spark, []), PATH, P.PATTERN)
    assert got.count() == 0 and "ids" in got.columns


def test_tail_is_cut_in_powers_of_two():
    for total in range(0, 200):
        cuts = pack.tail_cuts(total, 64)
        assert (cuts[-1] if cuts else total) == total
        sizes = [b - a for a, b in zip([total - total % 64, *cuts], cuts)]
        assert all(n & (n - 1) == 0 for n in sizes) and sizes == sorted(set(sizes), reverse=True)


def test_query_against_the_library(spark, reference):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    pieces = defaultdict(list)
    for p in QUERIES["op13_concat_cut"](spark, sf).collect():
        pieces[p.doc_id].append(p)
    assert len(pieces) == len(rows)
    for r in rows:
        ids = reference(r.text) + [0]
        at = 0
        for p in sorted(pieces[r.doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *ids[at:at + p.length]))
            at += p.length
        assert at == len(ids)
