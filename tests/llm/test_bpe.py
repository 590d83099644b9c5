import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from gatehouse.llm import prefix_bpe as B
from tests.llm.frames import LONG, collect, docs

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary(*B.load_vocabulary(PATH))


TEXTS = ["", " ", "  ", "a", " a", "a  b", "a \n b", "\n\n x\t y  \r\n", "don't we'll I'D", "x" * 3000, " " * 500 + "end",
         "ends with blank ", "\x1c a \x1d b", "a b   c", "naïve Übergröße señor 東京 日本語 🙂🙂", "1234567 3.14 a1b2",
         "<|endoftext|> is text", "aaaaaaaaaaaaaaaaaaaaaab" * 20, "é ́ x", "a\x85b \x85 c", "tab\tsep \t x"]


@pytest.mark.parametrize("text", TEXTS)
def test_as_tiktoken(reference, vocabulary, text):
    ids = B.Encoder(vocabulary, P.PATTERN).encode(text) if text else []
    assert ids == reference.encode_ordinary(text)
    assert vocabulary.decode(ids) == text.encode()


def test_random_texts(reference, vocabulary):
    r = random.Random(2)
    e = B.Encoder(vocabulary, P.PATTERN)
    for _ in range(1500):
        alphabet = r.choice(["ab ", "the aeiou \n", "0123 -.", "éüß ñ\t", "a'stl ", "日本 語🙂", " \n\t\r\x1c\x85 a"])
        text = "".join(r.choices(alphabet, k=r.randint(1, 60)))
        assert e.encode(text) == reference.encode_ordinary(text), repr(text)


def test_pieces_of_random_bytes_like_words(reference, vocabulary):
    r = random.Random(3)
    tokens = [t for t in vocabulary.ranks if t.isalpha() and t.isascii()]
    for _ in range(2000):
        piece = b"".join(r.choices(tokens, k=r.randint(1, 6)))
        assert vocabulary.encode_piece(piece) == reference._core_bpe.encode_single_piece(piece)


def test_append_is_exact(vocabulary):
    r = random.Random(4)
    for _ in range(200):
        p, data = B.PrefixEncoding(vocabulary), b""
        for _ in range(6):
            more = "".join(r.choices("therinaso", k=r.randint(1, 7))).encode()
            data += more
            p.append(more)
            assert p.tokens() == vocabulary.encode_piece(data)


def test_edit_recomputes_little(vocabulary):
    r = random.Random(5)
    data = "".join(r.choices("therinasoé", k=4000)).encode()
    p = B.PrefixEncoding(vocabulary, data)
    for _ in range(30):
        at = r.randrange(len(data) - 10)
        new = "".join(r.choices("therin", k=r.randint(0, 5))).encode()
        end = at + r.randint(0, 5)
        redone = p.replace(at, end, new)
        data = data[:at] + new + data[end:]
        assert p.data == data and p.tokens() == vocabulary.encode_piece(data)
        assert redone <= len(data) - at
    redone = p.replace(100, 102, b"th")
    assert redone < 1500


def test_frames(spark, reference):
    rows = [(1, "plain text"), (1, "plain text"), (2, None), (3, ""), (None, "no id"), (4, LONG)]
    df = docs(spark, rows)
    got = B.decode(B.encode(df, PATH, P.PATTERN, carry=["doc_id", "size"]), PATH)
    assert got.columns == ["doc_id", "size", "ids", "decoded"]
    out = {(r.doc_id, bytes(r.decoded).decode()): list(r.ids) for r in got.collect()}
    for i, t in rows:
        assert out[i, t or ""] == reference.encode_ordinary(t or "")
    assert got.count() == len(rows)
    digest = B.encode(df.where("doc_id = 1"), PATH, P.PATTERN, carry=["doc_id"]).select(B.ids_digest("ids")).first()[0]
    assert digest == hashlib.sha256(",".join(map(str, reference.encode_ordinary("plain text"))).encode()).hexdigest()
    assert collect(B.encode(docs(spark, []), PATH, P.PATTERN)) == []


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, [0, 1]), (3, [])], "k int, ids array<int>")
    got = {r.k: bytes(r.decoded) for r in B.decode(df, PATH).collect()}
    assert got[1] == got[3] == b"" and len(got[2]) == 2
