import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from gatehouse.llm import damage, turn_repair as T
from gatehouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_align(codes):
    """Least (cost, audit) by following the grammar's states from the front."""
    sys_limit = 3                               # roles put in at one place: never more pay off

    @lru_cache(None)
    def go(i, state, put):
        out = [(0, "")] if i == len(codes) and state in ("start", "even") else []
        if put < sys_limit:
            if state in ("start", "even", "lead"):
                c, a = go(i, "odd", put + 1)
                out.append((c + 5, "I" + a))
            if state == "odd":
                c, a = go(i, "even", put + 1)
                out.append((c + 5, "I" + a))
        if i < len(codes):
            x = codes[i]
            c, a = go(i + 1, state, 0)
            out.append((c + 2, "D" + a))
            if x != "-":
                cut, low = 5 * (x != x.lower()), x.lower()
                if state == "start" and low == "s":
                    c, a = go(i + 1, "lead", 0)
                    out.append((c + cut, "K" + a))
                want, then = ("a", "even") if state == "odd" else ("u", "odd")
                c, a = go(i + 1, then, 0)
                out.append((c + cut + (low != want), ("K" if low == want else "R") + a))
        return min(out, default=(1 << 40, ""))

    return go(0, "start", 0)


def test_align_against_the_grammar():
    r = random.Random(1)
    for _ in range(4000):
        codes = "".join(r.choices(r.choice(["ua", "uas", "uasxUASX-", "uauauaA-", "aaau-", "sS-x", "UA"]), k=r.randint(0, 9)))
        assert T.align(codes) == plain_align(codes), codes


def test_long_conversations_and_block_borders(monkeypatch):
    r = random.Random(2)
    texts = ["".join(r.choices("uuaaauasxU-A", k=n)) for n in (50, 90, 140)] + ["ua" * 60, "u" * 99, "s" * 60, "-" * 70]
    want = [plain_align(c) for c in texts]
    assert [T.align(c) for c in texts] == want
    for block in (1, 7, 32):
        monkeypatch.setattr(T, "BLOCK", block)
        assert [T.align(c) for c in texts] == want


def test_a_very_long_conversation():
    r = random.Random(3)
    codes = "".join(r.choices("uauauauauaU-Asx", k=60_000))
    cost, audit = T.align(codes)
    assert len(audit) - audit.count("I") == len(codes) and cost > 0


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub(r"[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out.append((c, t, role, text, (0, 2)[code == 3] or (0 if code == 0 else 1)))
    return out


def plain_repair(rows):
    """{conversation: every column} of undamaged (conv, turn, role, text) rows."""
    convs = defaultdict(list)
    for c, t, role, text, times in plain_damage(rows):
        convs[c] += [(t, role, text)] * times
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()))
        seen, codes, n = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for t, role, text in turns:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else None if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            x = role[:1] if role[:1] in ("u", "a", "s") else "x"
            if fault:
                n[fault] += 1
            codes += "-" if fault in ("blank", "duplicate") else x.upper() if fault else x
        roles = [role[:1] for _, role, _ in turns]
        numbers = {t for t, _, _ in turns if t is not None}
        cost, audit = plain_align(codes)
        left, at, lines = len(audit) - audit.count("D"), 0, []
        for e in audit:
            named = "assistant" if left & 1 else "user"
            if e == "I":
                lines.append(f"{named}:")
            else:
                _, role, text = turns[at]
                at += 1
                if e != "D":
                    lines.append(f"{role if e == 'K' else named}:{text}")
            left -= e != "D"
        out[c] = dict(gaps=max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, **n,
                      illegal=sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
                      cost=cost, audit=audit, repaired_sha256=hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, rows, got):
    want = plain_repair(rows)
    assert len(got) == len(want)
    for r in got:
        d = r.asDict()
        assert {k: d[k] for k in want[d["conv_id"]]} == want[d["conv_id"]], d


def random_turns(r, convs):
    texts = ["Hello.", "What?", "cut off", "", "  \n", "Yes!", "x. \t", "é 🙂.", None]
    return [(c, t if r.random() < .9 else None, r.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), r.choice(texts))
            for c in convs for t in range(r.randint(1, 9))]


def query_on(spark, df, path):
    df.write.parquet(f"{path}/conversations.parquet")
    return QUERIES["op11_turn_alignment"](spark, path)


def test_query_on_random_turns(spark, tmp_dir):
    rows = random_turns(random.Random(4), [*range(150), None, -7])
    rows += [(9, 3, "user", "Hello.")] * 3 + [(8, 2 ** 40, "assistant", "late.")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    check(spark, rows, query_on(spark, df, tmp_dir).collect())


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows, QUERIES["op11_turn_alignment"](spark, SF).collect())


def test_empty_table_and_conversations_without_turns(spark, tmp_dir):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert query_on(spark, df, tmp_dir).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 1, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    r = QUERIES["op11_turn_alignment"](spark, _written(df, tmp_dir + "/one")).first()
    assert tuple(r)[:7] == (gone, 0, 0, 0, 0, 0, 0) and r.audit == "" and r.repaired_sha256 == hashlib.sha256(b"").hexdigest()


def _written(df, path):
    df.write.parquet(f"{path}/conversations.parquet")
    return path


def test_repaired_turns_and_clashing_columns(spark):
    rows = [("c", 1, "user", "Hi."), ("c", 2, "user", "cut"), ("c", 3, "assistant", "Yes."), ("d", 1, "system", "S."), ("d", 2, "user", "Q?")]
    df = spark.createDataFrame([(*x, "k", 5) for x in rows], "key string, n int, who string, said string, audit string, conv int")
    names = dict(conv="key", turn="n", role="who", text="said")
    found = T.audits(df, **names)
    assert {r.conv: (r.cost, r.audit) for r in found.collect()} == {"c": (2, "KDK"), "d": (2, "RR")}
    got = sorted(tuple(r) for r in T.repaired(df, found, **names).collect())
    assert got == [("c", 0, "K", 1, "user", "Hi."), ("c", 1, "K", 3, "assistant", "Yes."),
                   ("d", 0, "R", 1, "user", "S."), ("d", 1, "R", 2, "assistant", "Q?")]


def test_long_texts_and_one_hot_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(12_000)] + [(2, 0, "user", "word " * 200_000 + ".")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv: r for r in T.repair(df).collect()}
    want = hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in rows[:12_000]).encode()).hexdigest()
    assert got[1].cost == 0 and got[1].audit == "K" * 12_000 and got[1].repaired_sha256 == want
    assert got[2].audit == "D" and got[2].cost == 2
