"""Repair of conversations, by aligning their turns to the roles a conversation may have.

The roles of a sound conversation are ``s?`` and then ``ua`` any number of times, or
nothing. Turns are aligned to each string of that grammar as in Wagner and
Fischer's edit distance: keep, give another role, delete, insert. All the
strings end alike, so one matrix, over the turns from some place on and the
last ``r`` roles, serves every feasible length. The band of cells looked at is
Ukkonen's: with the least cost of the turns before a cell, by parity of what is
left, a cell counts only if that and its own cost do not exceed the cost
of the incumbent, the best repair a first sweep over the turns has found.
Cheapest repairs of all lengths are then traced together, letter by letter, and the
least audit is the one that is left.

A matrix row has a few cells, and rows are kept for one block of turns at a time,
with borders between blocks. So a conversation takes one byte a turn in memory, the
size of its audit, and its texts pass one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatehouse.llm.common import written

BLANKS = " \t\n\x0b\x0c\r"
BLOCK = 4096            # turns whose matrix rows are held
MEMO = 100_000          # short conversations' repairs kept per task; emptied when full
SHORT = 64              # turns of a conversation whose repair is kept
GONE = "-"              # a turn that must go
DELETE, RENAME, INSERT, CUT = 2, 1, 5, 5
NEVER = 1 << 60
FAULTS = ("blank", "duplicate", "truncated")


def turn_cost(code: str, role: str) -> int:
    """Cost of a turn (role initial, upper case if truncated, or ``-``) in the place of ``role``."""
    if code == GONE:
        return NEVER
    low = code.lower()
    if low == role:
        return CUT * (code != low)
    return NEVER if role == "s" else RENAME + CUT * (code != low)


COSTS = {c: tuple(turn_cost(c, r) for r in "uas") for c in "uasxUASX" + GONE}


def sweep(codes: str, row: tuple[int, int, int, int]) -> list[tuple[int, int, int, int]]:
    """Least costs before each turn and behind the last: with an even and an odd number of roles
    to come, with an ``s`` just set, and with nothing set."""
    out = [row]
    even, odd, lead, none = row
    for c in codes:
        u, a, s = COSTS[c]
        even, odd, lead, none = (min(even + DELETE, odd + a), min(odd + DELETE, even + u, lead + u),
                                 min(lead + DELETE, none + s), none + DELETE)
        odd = min(odd, even + INSERT, lead + INSERT)
        even = min(even, odd + INSERT)
        out.append((even, odd, lead, none))
    return out


FIRST = (0, INSERT, NEVER, 0)


def fill(codes: str, before: list[tuple[int, int, int, int]], best: int,
         below: tuple[dict[int, int], dict[int, int]] | None) -> list[tuple[dict[int, int], dict[int, int]]]:
    """Matrix rows of a block of turns from their last, with the row ``below`` them (none: the
    texts' end). A row has the cost by number of roles to come, and that with an ``s`` still to be set."""
    def inserted(cells: dict[int, int], even: int, odd: int) -> dict[int, int]:
        out: dict[int, int] = {}
        r, high = min(cells), max(cells)
        cost = NEVER
        while r <= high or cost + INSERT + (odd if r & 1 else even) <= best:
            cost = min(cells.get(r, NEVER), cost + INSERT)
            if cost + (odd if r & 1 else even) <= best:
                out[r] = cost
            else:
                cost = NEVER
            r += 1
        return out

    out = []
    if below is None:
        even, odd, lead, _ = before[-1]
        below = (inserted({0: 0}, min(even, lead), odd), {})
    out.append(below)
    for i in range(len(codes) - 1, -1, -1):
        (cells, leads), (u, a, s) = below, COSTS[codes[i]]
        even, odd, lead, none = before[i]
        here = {r: c + DELETE for r, c in cells.items()}
        for r, c in cells.items():
            c += u if r & 1 else a                      # the role before the last r
            if c < here.get(r + 1, NEVER):
                here[r + 1] = c
        here = inserted(here, min(even, lead), odd) if here else here
        first = {r: c + DELETE for r, c in leads.items()}
        if s < NEVER:
            for r, c in cells.items():
                if r and not r & 1 and c + s < first.get(r, NEVER):
                    first[r] = c + s
        below = (here, {r: c for r, c in first.items() if none + c <= best})
        out.append(below)
    return out[::-1]


def align(codes: str) -> tuple[int, str]:
    """Least cost of a repair, and the ASCII-least audit of that cost: the initials of its edits in order."""
    n = len(codes)
    row, borders = FIRST, [FIRST]
    for at in range(0, n, BLOCK):
        row = sweep(codes[at:at + BLOCK], row)[-1]
        borders.append(row)
    best = row[0]
    blocks = range(0, n, BLOCK)
    below, held = None, []
    for k in reversed(range(len(blocks))):
        held.append(below)
        part = codes[blocks[k]:blocks[k] + BLOCK]
        below = fill(part, sweep(part, borders[k]), best, below)[0]
    if not n:
        return 0, ""
    audit: list[str] = []
    # what is open: (an s still to be set, roles to come) of every cheapest repair
    open_ = {(False, r) for r, c in below[0].items() if c == best and not r & 1}
    open_ |= {(True, r) for r, c in below[1].items() if c == best}
    for k, border in zip(range(len(blocks)), reversed(held)):
        part = codes[blocks[k]:blocks[k] + BLOCK]
        rows = fill(part, sweep(part, borders[k]), best, border)
        for i, code in enumerate(part):
            u, a, s = COSTS[code]
            while True:
                (cells, leads), (next_cells, next_leads) = rows[i], rows[i + 1]
                deleted = {(t, r) for t, r in open_ if (next_leads if t else next_cells).get(r, NEVER) + DELETE
                           == (leads if t else cells)[r]}
                if deleted:
                    audit.append("D")
                    open_ = deleted
                    break
                added = {(t, r - 1) for t, r in open_ if not t and r and cells.get(r - 1, NEVER) + INSERT == cells[r]}
                if added:
                    audit.append("I")
                    open_ = added
                    continue
                low = code.lower()
                kept, named = set(), set()
                for t, r in open_:
                    if t:
                        if next_cells.get(r, NEVER) + s == leads[r]:
                            kept.add((False, r))
                    elif r and next_cells.get(r - 1, NEVER) + (a if r & 1 else u) == cells[r]:
                        (kept if low == ("a" if r & 1 else "u") else named).add((False, r - 1))
                audit.append("K" if kept else "R")
                open_ = kept or named
                break
    audit.append("I" * min(r for _, r in open_))        # roles behind the last turn
    return best, "".join(audit)


def repairs(codes_of: Iterator[str]) -> Iterator[tuple[int, str]]:
    """``align`` of each, short ones kept."""
    memo: dict[str, tuple[int, str]] = {}
    for codes in codes_of:
        got = memo.get(codes)
        if got is None:
            got = align(codes)
            if len(codes) <= SHORT:
                if len(memo) >= MEMO:
                    memo.clear()
                memo[codes] = got
        yield got


def _plain(turns: DataFrame, conv: str, turn: str, role: str, text: str, absent: str | None) -> DataFrame:
    """The columns the operator reads, under its own names; null roles and texts are one blank."""
    missing = F.coalesce(F.col(f"`{absent}`"), F.lit(False)) if absent else F.lit(False)
    row = turns.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
                       F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"), missing.alias("absent"))
    same = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return row.withColumn("digest", F.unhex(F.sha2(same.cast("binary"), 256)))


def audits(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           absent: str | None = None) -> DataFrame:
    """One row a conversation: ``conv``, ``gaps``, the numbers of ``blank``, ``duplicate`` and
    ``truncated`` turns (the first that holds) and of ``illegal`` neighbours, ``cost`` and ``audit``.

    Turns are taken by number (null first), role and hash of the text. Rows whose
    column ``absent`` is true only name their conversation; one without other rows has
    zeros and an empty audit. Null roles and texts are one blank, a null conversation is
    one conversation; an empty table gives an empty result.
    """
    import pyarrow as pa
    rows = _plain(turns, conv, turn, role, text, absent)
    seen = Window.partitionBy("conv", "digest").orderBy(F.col("turn").asc_nulls_first())
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (F.when(body == "", 1).when(F.row_number().over(seen) > 1, 2)
             .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("u", "a", "s"), initial).otherwise("x")
    here = rows.where(~F.col("absent")).select("conv", "turn", "role", "digest", known.alias("initial"), fault.alias("fault"))
    named = (rows.where("absent").select("conv").distinct()
             .select("conv", *(F.lit(None).cast(t).alias(c) for c, t in here.dtypes[1:])))
    dealt = (here.unionByName(named).repartition("conv")
             .sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "digest")
             .select("conv", "turn", "initial", "fault"))
    counted = ("gaps", *FAULTS, "illegal")
    schema = dealt.select("conv", *(F.lit(0).cast("bigint").alias(c) for c in (*counted, "cost")), F.lit("").alias("audit")).schema
    legal = {"su", "ua", "au"}

    def run(batches: Iterator) -> Iterator:
        kept: list = []
        kind = None

        def conversations() -> Iterator:
            nonlocal kind
            now, open_ = None, False
            for batch in batches:
                kind = batch.column(0).type
                for c, t, x, f in zip(*(col.to_pylist() for col in batch.columns)):
                    if not open_ or c != now:
                        if open_:
                            yield now, codes, faults, illegal, turns_
                        now, open_, codes, faults, illegal, before = c, True, [], [0, 0, 0, 0], 0, ""
                        turns_ = [None, None, 0]
                    if x is None:
                        continue
                    codes.append(GONE if f in (1, 2) else x.upper() if f == 3 else x)
                    faults[f] += 1
                    illegal += bool(before) and before + x not in legal
                    before = x
                    if t is not None and t != turns_[1]:
                        turns_ = [t if turns_[0] is None else turns_[0], t, turns_[2] + 1]
            if open_:
                yield now, codes, faults, illegal, turns_

        def codes_of() -> Iterator[str]:
            for c, codes, faults, illegal, (low, high, distinct) in conversations():
                gaps = 0 if low is None else high - low + 1 - distinct
                kept.append((c, gaps, *faults[1:], illegal))
                yield "".join(codes)

        def out(done: list) -> pa.RecordBatch:
            cols = list(zip(*((*head, *tail) for head, tail in done)))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kind), *(pa.array(x, pa.int64()) for x in cols[1:-1]), pa.array(cols[-1], pa.string())],
                names=["conv", *counted, "cost", "audit"])

        done = []
        for tail in repairs(codes_of()):
            done.append((kept.pop(), tail))
            if len(done) == 1000:
                yield out(done)
                done = []
        if done:
            yield out(done)

    return dealt.mapInArrow(run, schema)


def _with_audits(turns: DataFrame, found: DataFrame, *names: str) -> DataFrame:
    """Each conversation's audit row, then its turns in order, in one task."""
    rows = _plain(turns, *names).where(~F.col("absent"))
    head = found.select("conv", F.struct("*").alias("found"))
    body = rows.select("conv", "turn", "role", "digest", "text")
    both = (head.select("conv", *(F.lit(None).cast(t).alias(c) for c, t in body.dtypes[1:]), "found")
            .unionByName(body.withColumn("found", F.lit(None).cast(head.schema["found"].dataType))))
    return (both.repartition("conv")
            .sortWithinPartitions("conv", F.col("found").isNull(), F.col("turn").asc_nulls_first(), "role", "digest")
            .select("conv", "found", "turn", "role", "text"))


class Replay:
    """The edits of one audit, turn by turn: (edit, role, text) of what stays or comes in."""

    def __init__(self, audit: str):
        self.audit, self.at = audit, 0
        self.left = len(audit) - audit.count("D")

    def _role(self) -> str:
        return "assistant" if self.left & 1 else "user"

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield "I", self._role(), ""
            self.left -= 1
            self.at += 1

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        if edit != "D":
            yield edit, role if edit == "K" else self._role(), text
            self.left -= 1
        self.at += 1


def _replayed(batches: Iterator) -> Iterator:
    """(found, turn, edit, role, text) in order; edit None opens a conversation."""
    replay = found = None
    for batch in batches:
        conv, heads, turns, roles, texts = batch.columns
        for i in range(len(batch)):
            head = heads[i].as_py()
            if head is not None:
                if replay is not None:
                    for e, r, t in replay.inserts():
                        yield found, None, e, r, t
                found, replay = head, Replay(head["audit"])
                yield found, None, None, None, None
                continue
            turn = turns[i].as_py()
            for e, r, t in replay.turn(roles[i].as_py(), texts[i].as_py()):
                yield found, None if e == "I" else turn, e, r, t
    if replay is not None:
        for e, r, t in replay.inserts():
            yield found, None, e, r, t


def repaired(turns: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text", absent: str | None = None) -> DataFrame:
    """The turns of the repaired conversations: ``conv``, ``place`` (from 0), ``edit``
    (K, R or I), ``turn`` (null if inserted), ``role``, ``text``. ``found`` is ``audits`` of the same table."""
    import pyarrow as pa
    dealt = _with_audits(turns, found, conv, turn, role, text, absent)
    schema = dealt.select("conv", F.lit(0).cast("bigint").alias("place"), F.lit("").alias("edit"), "turn", "role", "text").schema

    def run(batches: Iterator) -> Iterator:
        kind = None

        def typed() -> Iterator:
            nonlocal kind
            for b in batches:
                kind = b.column(0).type
                yield b

        def out(rows: list) -> pa.RecordBatch:
            types = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)

        rows, place, size = [], 0, 0
        for head, t, edit, r, x in _replayed(typed()):
            if edit is None:
                place = 0
                continue
            rows.append((head["conv"], place, edit, t, r, x))
            place, size = place + 1, size + len(x)
            if len(rows) == 5000 or size > 4_000_000:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)

    return dealt.mapInArrow(run, schema)


def digests(turns: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text", absent: str | None = None) -> DataFrame:
    """``found`` with ``repaired_sha256``: the hash of the repaired ``role:text``, joined by line ends."""
    import pyarrow as pa
    dealt = _with_audits(turns, found, conv, turn, role, text, absent)
    schema = found.withColumn("repaired_sha256", F.lit("")).schema

    def run(batches: Iterator) -> Iterator:
        kind = None

        def typed() -> Iterator:
            nonlocal kind
            for b in batches:
                kind = b.column(1).type
                yield b

        def out(heads: list, hashes: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*pa.array(heads, kind).flatten(), pa.array(hashes, pa.string())], names=schema.names)

        heads, hashes, now, first = [], [], None, True
        for head, _, edit, r, x in _replayed(typed()):
            if edit is None:
                if now is not None:
                    hashes.append(now.hexdigest())
                if len(hashes) == 1000:
                    yield out(heads, hashes)
                    heads, hashes = [], []
                heads.append(head)
                now, first = hashlib.sha256(), True
                continue
            now.update(("" if first else "\n").encode() + f"{r}:{x}".encode())
            first = False
        if now is not None:
            hashes.append(now.hexdigest())
            yield out(heads, hashes)

    return dealt.mapInArrow(run, schema)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           absent: str | None = None) -> DataFrame:
    """``audits`` with ``repaired_sha256``."""
    found = written(audits(turns, conv, turn, role, text, absent), "turn-audits")
    return digests(turns, found, conv, turn, role, text, absent)
