import random
import re
import string

import pytest

from gatehouse.llm import secrets_battery as S
from tests.llm.frames import LONG, collect, docs

PATS = (re.compile(S.ASSIGN, re.I | re.A), re.compile(S.ACCESS), re.compile(S.HEX), re.compile(r"[A-Za-z0-9+/_.=-]{20,}"))


def plain(text):
    out = [(0, m.start(), m.end()) for m in re.finditer(S.ASSIGN, text, re.I | re.A) if len(m.group(2)) >= 6]
    out += [(1, m.start(), m.end()) for m in re.finditer(S.ACCESS, text) if m.end() - m.start() >= 20]
    out += [(2, m.start(), m.end()) for m in re.finditer(S.HEX, text) if m.end() - m.start() >= 24]
    return sorted(out, key=lambda s: (s[1], s[0]))


CASES = ["", "password=hunter22", "PASSWD : \"abcdef", "api_key='x' apikey=abcdef", "token: token: abcdefg", "secret=short",
         "AKIA" + "A1" * 10, "AKIAAKIA" + "B" * 20, "xAKIA" + "Z" * 16 + "y", "f" * 24, "f" * 23, "token = \"" + "0a" * 20,
         "é password=abc123é", "toKen=Kabcdef", "paſſword=abcdefg", "a" * 30 + "/" + "deadbeef" * 4,
         "password=AKIA" + "C" * 20]


@pytest.mark.parametrize("text", CASES)
def test_base_spans(text):
    assert S.base_spans(text, PATS) == plain(text)


def test_base_spans_of_random_texts():
    r = random.Random(1)
    parts = ["password", "token", "AKIA", "=", ": ", "'", "\"", "abcdef", "0123456789abcdef", "XYZ123", " ", "\n", "é", "api_key"]
    for _ in range(3000):
        text = "".join(r.choices(parts, k=r.randint(1, 14)))
        assert S.base_spans(text, PATS) == plain(text), text


def test_battery_is_uniform_on_random_and_low_on_words():
    r = random.Random(2)
    for name, alphabet in S.ENCODINGS.items():
        ps = [S.battery("".join(r.choices(alphabet, k=40)), name) for _ in range(400)]
        assert sum(p > 0.1 for p in ps) > 320, name
    for word in ("internationalisations", "counterrevolutionaries", "aaaaaaaaaaaaaaaaaaaaaaaa", "abcabcabcabcabcabcabcabc",
                 "0123456789012345678901234567890123456789", "enschschlicheneinungkeit", "www.example.com/some/path/of/words"):
        enc = S.encoding_of(word)
        assert enc is None or S.battery(word, enc) < S.THIN_CUT, word


def test_random_keys_are_added_and_words_are_not(spark):
    r = random.Random(3)
    keys = ["".join(r.choices(string.ascii_letters + string.digits, k=40)) for _ in range(120)]
    words = ["".join(r.choices("en sch lich keit ung der ein".split(), k=7)) for _ in range(300)]
    rows = [(i, f"some text {k} goes on") for i, k in enumerate(keys + words)]
    got = {i: spans for i, spans in collect(S.find_secrets(docs(spark, rows), carry=["doc_id"]).select("doc_id", "spans"))}
    hit = sum(bool(got[i]) for i in range(120))
    wrong = sum(bool(got[i]) for i in range(120, 420))
    assert hit >= 100 and wrong <= 0.05 * hit + 3
    for i in range(120):
        assert all(rows[i][1][s.start:s.end] == keys[i] for s in got[i])


def key(r, n=40, more=""):
    return "".join(r.choices(string.ascii_letters + string.digits + more, k=n))


def test_keys_in_real_notation_are_candidates():
    r = random.Random(6)
    for _ in range(50):
        k, k2, k3, b64 = key(r), key(r), key(r), "x" + key(r, 46, "+/") + "x"
        hexa = "".join(r.choices("0123456789abcdef", k=32))
        for text, wanted in ((f"client_key={k}", [k]), (f"aws_secret_access_key={b64}==", [b64]), (f"https://a.example/get?sig={k}&x=1", [k]),
                             (f"see host.name/{k} there", [k]), (f"{k}.{k2}.{k3}", [k, k2, k3]), (f"{hexa}.{k}", [k]),
                             (f"{k}+ab/{k2}-c_{k3}", [k, k2, k3]), (f"{hexa}/{k}", [k])):
            got = [text[s:e] for s, e in S.candidates(text, S.base_spans(text, PATS), PATS[3])]
            assert set(wanted) <= set(got), text
            assert all(S.encoding_of(g) for g in got), text


def test_keys_in_real_notation_are_found(spark):
    r = random.Random(7)
    forms = ("client_key={}", "https://a.example/get?sig={}&x=1", "see host.name/some/longer/path/of/words/{} there", "aa.{}.bb", "x+y_{}")
    keys = [key(r) for _ in range(200)]
    rows = [(i, forms[i % 5].format(k)) for i, k in enumerate(keys)]
    got = dict(collect(S.find_secrets(docs(spark, rows), carry=["doc_id"]).select("doc_id", "spans")))
    for form in range(5):
        hit = sum(any(s.start <= rows[i][1].index(keys[i]) and s.end >= rows[i][1].index(keys[i]) + 40 for s in got[i])
                  for i in range(form, 200, 5))
        assert hit >= 28, forms[form]           # of 40; the thin cut misses a fifth
    for spans in got.values():
        assert all(not (a.start <= b.start and b.end <= a.end) for a in spans for b in spans if a is not b)


def test_frames(spark):
    rows = [(1, "password=hunter22 and " + "ab12" * 8), (1, "password=hunter22 and " + "ab12" * 8), (2, None), (3, ""),
            (None, "token: abcdef99"), (4, LONG + " secret=abcdefgh")]
    df = docs(spark, rows)
    got = S.find_secrets(df, carry=["doc_id", "size"])
    out = got.select("doc_id", S.count_of("base", 0).alias("a"), S.count_of("base", 2).alias("h"), S.joined(got["spans"]).alias("s"))
    assert sorted(collect(out), key=str) == sorted([
        (1, 1, 1, "assign:0:17,hex:22:54"), (1, 1, 1, "assign:0:17,hex:22:54"), (2, 0, 0, ""), (3, 0, 0, ""),
        (None, 1, 0, "assign:0:15"), (4, 1, 0, f"assign:{len(LONG) + 1}:{len(LONG) + 16}")], key=str)
    red = S.redact(df)
    assert red.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in red.collect()), key=str) == sorted([
        (1, "[SECRET] and [SECRET]"), (1, "[SECRET] and [SECRET]"), (2, None), (3, ""), (None, "[SECRET]"),
        (4, LONG + " [SECRET]")], key=str)
    assert collect(S.find_secrets(docs(spark, []))) == [] and collect(S.redact(docs(spark, []))) == []


def test_overlapping_spans_are_masked_once(spark):
    text = "token = \"" + "0a" * 20 + " tail"
    assert S.redact(docs(spark, [(1, text)])).first().text == "[SECRET] tail"
