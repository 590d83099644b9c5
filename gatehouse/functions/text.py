"""Text rules: white-space strip, trailing-slash strip, newline normalisation,
blank checks and unfinished-template flags (P1, P2, P5, F2, F3, F5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (``str.isspace``),
# 29 of them, all below U+3100: TAB LF VT FF CR (09-0D), FS GS RS US SPACE
# (1C-20), NEL (85), NBSP (A0), OGHAM SPACE (1680), EN QUAD..HAIR SPACE
# (2000-200A), LINE SEP (2028), PARAGRAPH SEP (2029), NNBSP (202F), MMSP (205F),
# IDEOGRAPHIC SPACE (3000). Spark's default ``trim`` knows only the blank.
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
               "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
NOT_WHITE_SPACE = (r"[^\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
                   r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

# Leftovers of an unfinished answer template.
TODO_PATTERN = r"\bTODO\b"
NOT_IMPLEMENTED_PATTERN = r"\bNotImplementedError\b"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space at both ends, as Python ``str.strip()``.

    A trim, not a pattern: linear in the text, also for long runs of blanks.
    """
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def rstrip_slash(c: Column | str) -> Column:
    """Drop every trailing ``/``."""
    return F.rtrim(_col(c), F.lit("/"))


def normalise_newlines(c: Column | str) -> Column:
    """P5: text-mode reading turns CRLF and lone CR into LF."""
    return F.regexp_replace(_col(c), "\r\n?", "\n")


def is_blank(c: Column | str) -> Column:
    """holds no character but white space (null stays null).

    The search ends at the first other character.
    """
    return ~_col(c).rlike(NOT_WHITE_SPACE)


def placeholder_flags(c: Column | str) -> Column:
    """struct(has_todo, has_not_implemented); flags only, rejects nothing.

    A stub ``None`` is too common in valid Python to detect by text, so it is
    not flagged.
    """
    c = _col(c)
    return F.struct(c.rlike(TODO_PATTERN).alias("has_todo"),
                    c.rlike(NOT_IMPLEMENTED_PATTERN).alias("has_not_implemented"))
