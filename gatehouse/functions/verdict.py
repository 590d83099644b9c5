"""Response rules: strict verdict parsing, outcome and exit code.

Bodies are parsed to VARIANT, not with ``from_json`` and a string schema:
``from_json`` coerces numbers and objects to text and turns non-JSON into a
struct of nulls, which would hide the malformed/unexpected distinction.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehouse.functions.text import _col

# The two statuses a verdict may carry, and the outcome codes in
# the order the client decides them (first match wins).
STATUSES = ("success", "error")
OUTCOMES = ("http_error", "unreachable", "malformed", "unexpected", "error", "success")



# JSON string literal, escapes included. Possessive quantifiers: Java's regex
# engine recurses per repetition of an alternation group and would overflow
# its stack on a long string; runs of plain characters are taken whole.
_JSON_STRING = r'"(?:[^"\\]++|\\.)*+"'
# A JSON value that is neither an object nor an array.
_JSON_SCALAR = rf'\A(?:{_JSON_STRING}|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)\z'
# A string literal as JSON allows it, and a text that holds one too long to parse along.
_VALID_STRING = r'\A"(?:[^"\\\x00-\x1f]++|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*+"\z'
_LONG = 1024
_HAS_LONG = rf'"[^"]{{{_LONG}}}'
# Stands for a literal that was put aside, before its number.
_MARK = "\x01"
# Bytes up to which Spark holds a parsed body, its long literals put aside.
_PARSED = 100 << 20


def _single_value(body: Column) -> Column:
    """False when text follows the first complete JSON value.

    Spark's JSON parser stops after the first value and ignores the rest; a
    strict parser rejects it. A scalar must be the whole text. A body that
    starts with an object or array must end with the matching bracket (this
    catches ``{} x``). A second value (``{} {}``) needs a second opening
    bracket somewhere in the text, so only bodies with more than one are
    checked further: with string literals removed, the brackets may return to
    depth zero only once (a fold over the bracket characters). Flat objects,
    the usual verdict, take the cheap path.
    """
    text = F.btrim(body, F.lit(" \t\n\r"))
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    matching = F.when(first == "{", last == "}").otherwise(last == "]")
    openers = F.length(text) - F.length(F.translate(text, "{[", ""))
    brackets = F.regexp_replace(F.regexp_replace(text, _JSON_STRING, ""), r"[^\[\]{}]", "")
    closes = F.aggregate(
        F.split(brackets, ""), F.struct(F.lit(0).alias("d"), F.lit(0).alias("z")),
        lambda acc, ch: F.struct(
            (acc["d"] + F.when(ch.isin("{", "["), 1).otherwise(-1)).alias("d"),
            (acc["z"] + F.when(acc["d"] + F.when(ch.isin("{", "["), 1).otherwise(-1) == 0, 1)
             .otherwise(0)).alias("z")))["z"]
    single = F.when(openers <= 1, F.lit(True)).otherwise(closes == 1)
    return F.when(first.isin("{", "["), matching & single).otherwise(text.rlike(_JSON_SCALAR))


def python_literals(body: Column | str) -> Column:
    """The body with bare ``NaN`` / ``Infinity`` / ``-Infinity`` as ``null``.

    Python's json module reads these three (as floats); JSON and Spark do
    not. A verdict only looks at ``status`` and ``message``, where a float and
    a null are equally wrong, so reading them as null gives Python's answer.
    Text inside string literals is left alone: the body is split around the
    literals and only the parts between them are rewritten. Bodies without
    these words are returned as they are.
    """
    body = _col(body)
    strings = F.regexp_extract_all(body, F.lit(_JSON_STRING), 0)
    between = F.split(body, _JSON_STRING)
    rebuilt = F.array_join(F.zip_with(
        between, F.concat(strings, F.array(F.lit(""))),
        lambda part, lit: F.concat(F.regexp_replace(part, r"-?Infinity|NaN", "null"), lit)), "")
    return F.when(body.contains("NaN") | body.contains("Infinity"), rebuilt).otherwise(body)


def readable_body(body: Column | str) -> Column:
    """The body as Spark's parser should see it: without a byte-order mark at the start (as
    Python's json module drops it for bytes), bare NaN and Infinity as null."""
    c = _col(body)
    return python_literals(F.when(c.startswith("\ufeff"), F.substring(c, 2, 2147483647)).otherwise(c))


def _literals(text: Column) -> Column:
    """The string literals of a text that may have long ones; null for any other text."""
    return F.when(text.rlike(_HAS_LONG), F.regexp_extract_all(text, F.lit(_JSON_STRING), 0))


def _cut(text: Column, literals: Column) -> Column:
    """The text with a mark and its number in place of each long literal.

    A parsed value has a size limit, and a verdict needs one long text at most. Only
    literals that JSON allows are put aside, so the others still make the
    body malformed; one that spells the mark itself is put aside too, so
    that a parsed text that begins with it is always a mark.
    """
    put = F.transform(literals, lambda x, i: F.when(
        ((F.length(x) > _LONG) | x.contains("\\u0001")) & x.rlike(_VALID_STRING),
        F.concat(F.lit('"\\u0001'), i.cast("string"), F.lit('"'))).otherwise(x))
    cut = F.array_join(F.zip_with(F.split(text, _JSON_STRING), F.concat(put, F.array(F.lit(""))), lambda part, x: F.concat(part, x)), "")
    whole = F.when(literals.isNull(), text).otherwise(cut)
    return F.when(F.octet_length(whole) > _PARSED, F.raise_error(F.lit("a response body is too large for Spark's JSON parser")).cast("string")).otherwise(whole)


def _message(v: Column, literals: Column) -> Column:
    """The top-level message, a literal that was put aside read back whole."""
    found = F.try_variant_get(v, "$.message", "string")
    marked = literals.isNotNull() & found.startswith(_MARK)
    literal = F.get(literals, F.substring(found, 2, 2147483647).try_cast("int"))
    whole = F.from_json(F.concat(F.lit("["), literal, F.lit("]")), "array<string>", {"maxStringLen": "2147483647"})[0]
    return F.when(marked, whole).otherwise(found)


def _shape(text: Column, v: Column, status: Column, message_type: Column) -> Column:
    ok = status.isin(*STATUSES) & (message_type == F.lit("STRING"))
    return (F.when(v.isNull() | ~_single_value(text), F.lit("malformed"))
            .when(F.coalesce(ok, F.lit(False)), F.lit("ok"))
            .otherwise(F.lit("unexpected")))


def _struct(shape: Column, status: Column, message: Column) -> Column:
    is_ok = shape == F.lit("ok")
    return F.struct(shape.alias("shape"), F.when(is_ok, status).alias("status"), F.when(is_ok, message).alias("message"))


def parse_verdict(body: Column | str) -> Column:
    """struct(shape, status, message).

    shape is ``malformed`` (not JSON), ``unexpected`` (JSON, but not an object
    with a ``status`` of success/error and a *string* ``message``) or ``ok``.
    Extra keys are ignored and an empty message is fine; of repeated keys the last counts;
    status and message are null unless the shape is ok. A message may be as long as a
    Spark text. For whole tables :func:`with_verdict` does the same in steps, so
    that nothing is evaluated twice.
    """
    def let(value: Column, then: Callable[[Column], Column]) -> Column:
        """``then`` of the value, which is evaluated once."""
        return F.element_at(F.transform(F.array(value), then), 1)

    def parsed(text: Column, literals: Column, v: Column) -> Column:
        status = F.try_variant_get(v, "$.status", "string")
        kind = F.schema_of_variant(F.try_variant_get(v, "$.message", "variant"))
        return _struct(_shape(text, v, status, kind), status, _message(v, literals))

    return let(readable_body(body), lambda whole: let(_literals(whole), lambda literals: let(
        _cut(whole, literals), lambda text: let(F.try_parse_json(text), lambda v: parsed(text, literals, v)))))


def with_verdict(df: DataFrame, body: str, out: str = "verdict") -> DataFrame:
    """``df`` with the struct of :func:`parse_verdict`, one projection a step:
    each body is cleaned, parsed and classified once."""
    steps = df.withColumn("_whole", readable_body(body))
    steps = steps.withColumn("_literals", _literals(F.col("_whole")))
    steps = steps.withColumn("_text", _cut(F.col("_whole"), F.col("_literals")))
    steps = steps.withColumn("_v", F.try_parse_json("_text"))
    steps = steps.withColumns({
        "_status": F.try_variant_get("_v", "$.status", "string"),
        "_kind": F.schema_of_variant(F.try_variant_get("_v", "$.message", "variant"))})
    steps = steps.withColumn("_shape", _shape(F.col("_text"), F.col("_v"), F.col("_status"), F.col("_kind")))
    return (steps.withColumn(out, _struct(F.col("_shape"), F.col("_status"), _message(F.col("_v"), F.col("_literals"))))
            .drop("_whole", "_literals", "_text", "_v", "_status", "_kind", "_shape"))


def classify(http_status: Column | str, transport_error: Column | str,
             verdict: Column) -> Column:
    """Outcome code, first match wins.

    A status outside 2xx is decided before the body is read; a transport
    error, or no status at all, means the service was not reached. ``verdict``
    is the struct from :func:`parse_verdict`.
    """
    st = _col(http_status)
    return (F.when(st.isNotNull() & ~st.between(200, 299), F.lit("http_error"))
            .when(_col(transport_error).isNotNull() | st.isNull(), F.lit("unreachable"))
            .when(verdict["shape"] == "malformed", F.lit("malformed"))
            .when(verdict["shape"] == "unexpected", F.lit("unexpected"))
            .otherwise(verdict["status"]))


def exit_code(outcome: Column | str) -> Column:
    """0 only for success."""
    return F.when(_col(outcome) == F.lit("success"), F.lit(0)).otherwise(F.lit(1))
