"""Damage that queries do to given tables, so that repairs have something to find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"


def periodic_text(doc_id: Column, text: Column) -> Column:
    """``text``, of one document in ten with its words from some place on repeating a short
    stretch of them. Null ids and texts without words stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = ((h - h % 10) / 10).cast("bigint")

    def whole(x: Column, y: Column) -> Column:
        return ((x - x % y) / y).cast("int")

    def repeat(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = 1 + whole(n - a, (3 + g % 8).cast("int"))
        times = whole(n - a + p - 1, p)
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), F.lit(1), n - a)
        return F.when(n > 0, F.concat(F.slice(w, F.lit(1), a), tail)).otherwise(w)

    words = F.array_remove(F.split(text, BLANK), "")
    once = F.element_at(F.transform(F.array(words), repeat), 1)            # the words are cut once
    return F.when(h % 10 == 0, F.array_join(once, " ")).otherwise(text)


def damaged_turns(turns: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with one turn in twenty each dropped
    (kept with ``absent`` true), emptied, without its full stops, said twice, or given to the
    user. Null roles and texts are one blank."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    role, text = shown("role"), shown("text")
    return turns.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (code == 0).alias("absent"), F.explode(F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1))).alias("_copy")
    ).drop("_copy")
