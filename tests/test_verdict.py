"""X1-X3 against Python's json module."""

import json

import pytest

from gatehouse.functions.verdict import classify, exit_code, parse_verdict


def stdlib_shape(body):
    try:
        v = json.loads(body)
    except (ValueError, TypeError):
        return "malformed"
    if (not isinstance(v, dict) or v.get("status") not in ("success", "error")
            or not isinstance(v.get("message"), str)):
        return "unexpected"
    return "ok"


BODIES = [
    '{"status":"success","message":"ok"}', '{"status":"error","message":""}',
    '{"status":"success","message":1}', '{"status":"success"}', '{"status":"ok","message":"m"}',
    '{"status":["success"],"message":"m"}', '{"status":"success","message":null}',
    '{"status":"success","message":{"a":1}}', "[1]", "null", "1", '"success"', "", "oops",
    '{"status":"error","message":"m","extra":[1,2]}',
    '{"status":"ok","message":"m","status":"success"}',   # repeated key: last wins
    ' \n{"status":"success","message":"m"}\n ',
    "{'status':'success','message':'m'}",
]
# Text after the first value: malformed, as in Python.
TRAILING = ['{"status":"success","message":"m"} x', '{"status":"success","message":"m"} {}',
            '{"status":"success","message":"m"}[1]', '[1] [2]', '{} {"a": 1}',
            '{"status":"success","message":"}{"}', '{"status":"success","message":"\\"}{"}',
            '{"status":"success","message":"a\\\\"} ', '{"status":"success","message":"[{"}']
# Python reads NaN / Infinity / -Infinity (not JSON): same shapes as Python.
PY_LITERALS = ['{"status":"success","message":"m","n":NaN}', '{"status":"success","message":"m","n":-Infinity}',
               '{"status":NaN,"message":"m"}', '{"status":"success","message":Infinity}', "NaN",
               '{"status":"success","message":"NaN"}', '{"status":"error","message":"say \\"NaN\\" Infinity"}',
               '{"status":"success","message":"m","n":NaNx}', '{"status":"success","message":"m","n":-NaN}',
               '{"status":"success","message":"m","n":[NaN, Infinity]}']


@pytest.mark.parametrize("body", PY_LITERALS)
def test_python_literals_like_json_module(spark, body):
    df = spark.createDataFrame([(body,)], "b string")
    got = df.select(parse_verdict("b").alias("v")).select("v.*").first()
    assert got.shape == stdlib_shape(body)
    if got.shape == "ok":
        assert got.message == json.loads(body)["message"]


@pytest.mark.parametrize("body", TRAILING)
def test_text_after_value_like_json_module(spark, body):
    df = spark.createDataFrame([(body,)], "b string")
    assert df.select(parse_verdict("b")["shape"]).first()[0] == stdlib_shape(body)


def test_count():
    assert len(BODIES) == 18


@pytest.mark.parametrize("body", BODIES)
def test_shape_matches_json_module(spark, body):
    df = spark.createDataFrame([(body,)], "b string")
    assert df.select(parse_verdict("b")["shape"]).first()[0] == stdlib_shape(body)


def test_outcome_order_and_exit_code(spark):
    rows = [
        (500, None, '{"status":"success","message":"m"}', "http_error"),
        (404, "refused", None, "http_error"),
        (None, "timeout", None, "unreachable"),
        (None, None, None, "unreachable"),
        (200, None, "nope", "malformed"),
        (204, None, "[1]", "unexpected"),
        (200, None, '{"status":"error","message":"bad"}', "error"),
        (200, None, '{"status":"success","message":"ok"}', "success"),
    ]
    df = spark.createDataFrame(rows, "st int, err string, body string, want string")
    v = parse_verdict("body")
    out = df.select("want", classify("st", "err", v).alias("o")).withColumn("x", exit_code("o"))
    got = out.collect()
    assert [r.o for r in got] == [r[3] for r in rows]
    assert [r.x for r in got] == [0 if r[3] == "success" else 1 for r in rows]


def test_status_and_message_only_when_ok(spark):
    df = spark.createDataFrame([('{"status":"error","message":"why"}',), ('{"status":"x","message":"m"}',)], "b string")
    got = df.select(parse_verdict("b").alias("v")).select("v.*").collect()
    assert tuple(got[0]) == ("ok", "error", "why")
    assert tuple(got[1]) == ("unexpected", None, None)


def test_judge_runs_unchanged_on_a_stream(spark, tmp_dir):
    import os

    from gatehouse.plans import fixtures as fx
    from gatehouse.plans.jobs import judge, judge_job

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    src = os.path.join(tmp_dir, "responses")
    fx.responses(spark, sf).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    sink, ck = os.path.join(tmp_dir, "verdicts"), os.path.join(tmp_dir, "ck")
    q = (judge(stream).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ck).partitionBy("outcome")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(sink).select("sub_id", "outcome", "message", "exit_code")
    want = judge_job(spark, sf).select("sub_id", "outcome", "message", "exit_code")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_long_bodies_do_not_overflow(spark):
    # Java's regex engine recurses per repetition of an alternation group;
    # the string-literal pattern must stay iterative on long strings
    big = '{"status":"success","message":"' + "a" * 1_000_000 + '","x":[1,[2]]}'
    esc = '{"status":"error","message":"' + "\\\\n" * 200_000 + '","x":[NaN]}'
    df = spark.createDataFrame([(big,), (esc,)], "b string")
    got = [r[0] for r in df.select(parse_verdict("b")["shape"]).collect()]
    assert got == [stdlib_shape(big), stdlib_shape(esc)] == ["ok", "ok"]


SCALARS = ["null x", "1 2", '"a" b', "true false", "null", " 12 ", "-1.5e3", "01", "1.", '"open', "nul", "NaN", "Infinity x", '"a\\" b"']


@pytest.mark.parametrize("body", SCALARS)
def test_text_after_a_scalar(spark, body):
    df = spark.createDataFrame([(body,)], "b string")
    assert df.select(parse_verdict("b")["shape"]).first()[0] == stdlib_shape(body)


def test_byte_order_mark(spark):
    import json
    body = '{"status":"success","message":"m"}'
    assert json.loads(b"\xef\xbb\xbf" + body.encode())["message"] == "m"
    df = spark.createDataFrame([("\ufeff" + body,), ("\ufeff\ufeff" + body,)], "b string")
    assert [r[0] for r in df.select(parse_verdict("b")["shape"]).collect()] == ["ok", "malformed"]


def test_steps_agree_with_the_expression(spark):
    from gatehouse.functions.verdict import with_verdict
    df = spark.createDataFrame([(b,) for b in [*BODIES, *SCALARS, None]], "b string")
    both = with_verdict(df, "b").withColumn("w", parse_verdict("b")).collect()
    assert all(r.verdict == r.w for r in both)


def test_body_over_the_variant_limit(spark):
    message = "m" * 17_500_000                          # above 16 MiB, the most a variant holds
    body = '{"x":[1],"status":"success","message":"' + message + '"}'
    df = spark.createDataFrame([(body,)], "b string")
    r = df.select(parse_verdict("b").alias("v")).selectExpr("v.shape", "v.status", "length(v.message) as n").first()
    assert (r.shape, r.status, r.n) == ("ok", "success", len(message))


def _long_bodies(n):
    """Bodies with long texts: repeated, escaped and nested keys, marks, and faults in what is put aside."""
    x, q = "x" * n, '\\"\\u00e9\\n' * (n // 10)
    return [f'{{"status":"success","message":"a","message":"b","pad":"{x}"}}',
            f'{{"status":"success","message":"{x}","message":"b"}}',
            f'{{"status":"success","message":"a","message":"{q}"}}',
            f'{{"message":{{"message":"{x}"}},"status":"error","message":"{x}y"}}',
            f'{{"more":[{{"message":"{x}"}},"{x}"],"status":"error","message":"{q}{x}"}}',
            f'{{"status":"success","message":"{x}","message":1}}',
            f'{{"status":"{x}","message":"m","status":"error"}}',
            f'{{"pad":"{x}","status":"success","message":"\\u00010"}}',
            f'{{"\\u006dessage":"{x}","status":"success"}}',
            f'{{"{x}":1,"status":"success","message":"m","n":NaN}}',
            f'{{"status":"success","message":"{x}\t"}}', f'{{"status":"success","message":"{x}\\x"}}',
            f'{{"status":"success","message":"{x}"}} {{"a":"{x}"}}', f'"{x}"', f'["{x}","{x}"]', f'﻿{{"status":"error","message":"{x}"}}',
            f'{{"status":"success","message":"{x}}}']


@pytest.mark.parametrize("n", [40, 1000, 1100, 70_000, 1_200_000])
def test_long_texts_like_json_module(spark, n):
    from gatehouse.functions.verdict import with_verdict
    bodies = _long_bodies(n)
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, b string")
    got = {r.i: r.verdict for r in with_verdict(df, "b").select("i", "verdict").collect()}
    for i, b in enumerate(bodies):
        b = b.removeprefix("﻿")
        assert got[i].shape == stdlib_shape(b), b[:80]
        if got[i].shape == "ok":
            v = json.loads(b)
            assert (got[i].status, got[i].message) == (v["status"], v["message"]), b[:80]
    one = {r.i: r.v for r in df.where("i < 6").select("i", parse_verdict("b").alias("v")).collect()}
    assert all(one[i] == got[i] for i in one)


def test_twenty_megabytes(spark):
    from pyspark.sql import functions as F

    from gatehouse.functions.verdict import with_verdict
    n = 10 << 20                    # twice
    df = spark.range(1).select(F.concat(F.lit('{"status":"success","message":"first","message":"'), F.repeat(F.lit("0123456789abcde\\n"), n // 17),
                                        F.lit('","message":"'), F.repeat(F.lit("0123456789abcde\\n"), n // 17), F.lit('","x":1}')).alias("b"))
    r = with_verdict(df, "b").select("verdict.shape", F.length("verdict.message"), F.sha2(F.col("verdict.message").cast("binary"), 256)).first()
    import hashlib
    want = "0123456789abcde\n" * (n // 17)
    assert tuple(r) == ("ok", len(want), hashlib.sha256(want.encode()).hexdigest())
