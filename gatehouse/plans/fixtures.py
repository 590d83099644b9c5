"""Inputs of the jobs, derived from the driver tables by Spark.

The reference works on one submission at a time; we run on tables. These views
turn the driver's tables into tables of submissions, service addresses and
service responses. Every view keeps every input row: the ``% k`` rules below
only choose *which failure case* a row exercises, they never drop rows.
The same views exist as SQL in :mod:`gatehouse.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatehouse.functions.text import is_blank


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(req_id, raw_url): one service address per page, 16 address cases."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    pid = F.col("page_id")
    url = F.col("url")
    k = pid % 16
    host = F.concat(F.lit("http://h"), _s(pid))
    raw = (F.when(k == 0, F.concat(F.lit("\t "), url, F.lit("\n")))
           .when(k == 1, F.concat(url, F.lit("///")))
           .when(k == 2, F.replace(url, F.lit("://"), F.lit("://u:p@")))
           .when(k == 3, F.replace(url, F.lit("http"), F.lit("ftp")))
           .when(k == 4, F.concat(F.lit("http://h"), _s(pid), F.lit(".example:65536")))
           .when(k == 5, F.concat(F.lit("HTTPS://h"), _s(pid), F.lit(".example:8080/base/")))
           .when(k == 6, F.concat(F.lit("http://@h"), _s(pid)))
           .when(k == 7, F.lit(""))
           .when(k == 8, F.concat(F.lit("http://h"), _s(pid), F.lit("?")))
           .when(k == 9, F.concat(F.lit("http://[::1]:"), _s(pid)))
           .when(k == 10, F.concat(F.lit("\u00a0http://h_"), _s(pid)))
           .when(k == 11, F.concat(host, F.lit("\n/")))           # line ends before the last slash
           .when(k == 12, F.concat(host, F.lit("\r/")))
           .when(k == 13, F.concat(host, F.lit("\u2028/")))
           .when(k == 14, F.concat(host, F.lit(":80\n/")))
           .otherwise(url))
    return p.select(pid.alias("req_id"), raw.alias("raw_url"))


# The course tasks of the fixture. Slot = sub_id % 10. Cases: two
# lessons whose ``realization.py`` holds a shell command (exceptions), DAG tasks,
# a task with no endpoint yet, a three-file bundle, a task with an empty
# endpoint and no default file, plain Python and plain text tasks, and a
# bundle of one file.
TASKS = [
    # slot, task_id, endpoint, expected default file names (in order), bundle
    (0, "4.11.1", "/api/v1/checks/4.11.1", ["realization.py"], False),
    (1, "4.12.1", "/api/v1/checks/4.12.1", ["dag.py"], False),
    (2, "2.3.1", None, ["realization.txt"], False),
    (3, "5.4.2", "/api/v1/checks/5.4.2", ["connection_interests.py", "run_jobs.sh", "dag.py"], True),
    (4, "5.2.5", "", None, False),
    (5, "4.11.2", "/api/v1/checks/4.11.2", ["realization.py"], False),
    (6, "5.3.6", "/api/v1/checks/5.3.6", ["dag.py"], False),
    (7, "3.1.2", "/api/v1/checks/3.1.2", ["realization.py"], False),
    (8, "4.9.1", "/api/v1/checks/4.9.1", ["realization.py"], True),
    (9, "2.1.4", "/api/v1/checks/2.1.4", ["realization.txt"], False),
]
SLOTS = len(TASKS)
TASK_SCHEMA = T.StructType([
    T.StructField("slot", T.LongType(), False),
    T.StructField("task_id", T.StringType(), False),
    T.StructField("endpoint", T.StringType(), True),
    T.StructField("expected", T.ArrayType(T.StringType()), True),
    T.StructField("bundle", T.BooleanType(), False),
])

# What each answer file holds, by name, and the per-lesson
# exceptions (lessons 4.11.1 and 4.11.2 keep a shell command in realization.py).
KINDS = [
    ("realization.py", "python_code"),
    ("realization.txt", "expected_output"),
    ("dag.py", "dag"),
]
EXCEPTIONS = [
    ("4.11.1", "realization.py", "shell_command"),
    ("4.11.2", "realization.py", "shell_command"),
]

# Fixed value: the default service address used when a submission brings no
# override (P4). A placeholder host: no service is ever contacted.
DEFAULT_BASE_URL = "https://checks.invalid"
DEFAULT_SETTINGS = {"base_url": DEFAULT_BASE_URL, "student_key": "nobody"}


def _value(v, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        if v is None:
            return F.lit(None).cast(dtype)
        return F.array(*[_value(x, dtype.elementType) for x in v]).cast(dtype)
    return F.lit(v).cast(dtype)


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small fixed table as a JVM-side literal relation.

    ``createDataFrame`` on a Python list goes through Python workers at run
    time; an inline array of literal structs is planned and run in the JVM.
    """
    structs = [F.struct(*[_value(v, f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def tasks(spark: SparkSession) -> DataFrame:
    """Task dimension: a handful of rows, bounded by the course, not the data."""
    return literal_table(spark, TASKS, TASK_SCHEMA)


def kinds(spark: SparkSession) -> DataFrame:
    return literal_table(spark, KINDS, T.StructType([T.StructField("name", T.StringType()),
                                                     T.StructField("kind", T.StringType())]))


def exceptions(spark: SparkSession) -> DataFrame:
    return literal_table(spark, EXCEPTIONS, T.StructType([T.StructField("task_id", T.StringType()),
                                                          T.StructField("name", T.StringType()),
                                                          T.StructField("kind", T.StringType())]))


def task_of(sub_id: Column) -> Column:
    """The task id of a submission: slot = sub_id % SLOTS (see TASKS)."""
    expr = None
    for slot, task_id, *_ in TASKS:
        expr = (F.when(sub_id % SLOTS == slot, F.lit(task_id)) if expr is None
                else expr.when(sub_id % SLOTS == slot, F.lit(task_id)))
    return expr


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sub_id, student_id, task_id, pos, name, content): one row per file.

    A conversation is a submission, each turn one file lying in the task
    folder at position ``pos``. Cases: blank student key, blank files,
    ``TODO`` / ``NotImplementedError`` leftovers, CRLF line ends.
    """
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, turn, text = F.col("conv_id"), F.col("turn"), F.col("text")
    k = (conv * 3 + turn) % 29
    content = (F.when(k == 0, F.lit(""))
               .when(k == 1, F.lit(" \t\n"))
               .when(k == 2, F.concat(text, F.lit(" TODO")))
               .when(k == 3, F.concat(F.lit("raise NotImplementedError "), text))
               .when(k == 4, F.concat(text, F.lit("\r\nx")))
               .otherwise(text))
    student = F.when(conv % 13 == 0, F.lit(" \t")).otherwise(F.concat(F.lit("u"), _s(conv)))
    return c.select(
        conv.alias("sub_id"),
        student.alias("student_id"),
        task_of(conv).alias("task_id"),
        turn.alias("pos"),
        F.concat(F.col("role"), F.lit("_"), _s(turn), F.lit(".py")).alias("name"),
        content.alias("content"),
    )


def explicit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sub_id, pos, path): paths named on the command line, null = none named.

    For sub_id % 3 = 0 the first ``sub_id % 4`` turns are named explicitly
    (0, 1, 2 or 3 paths), which reaches every arity case.
    """
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    conv, turn = F.col("conv_id"), F.col("turn")
    named = (conv % 3 == 0) & (turn < conv % 4)
    path = F.concat(F.lit("in/"), _s(conv), F.lit("/"), F.col("role"), F.lit("_"), _s(turn), F.lit(".py"))
    return c.select(conv.alias("sub_id"), turn.alias("pos"), F.when(named, path).alias("path"))


def stored_files(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    """(sub_id, path, content, readable): the files that lie on storage, and whose they are.

    Every turn has an explicit copy under ``in/`` and, where its task expects a
    file at that position, a default copy in the submission's task folder,
    with another text. Some of either are missing (no row), not UTF-8 (``readable``
    false, null content) or empty (zero bytes). With ``raw`` the content is the files' bytes.
    """
    subs = submissions(spark, sf_dir)
    expected = tasks(spark).select("task_id", "expected")
    rows = subs.select("sub_id", "task_id", "pos", "name", "content").join(expected, "task_id")
    k = (F.col("sub_id") * 7 + F.col("pos")) % 31
    blank = is_blank("content")
    default_name = F.try_element_at("expected", (F.col("pos") + 1).cast("int"))
    explicit = F.struct(F.concat(F.lit("in/"), _s(F.col("sub_id")), F.lit("/"), "name").alias("path"),
                        F.col("content").alias("content"), (k != 5).alias("readable"), (k != 7).alias("there"))
    default = F.struct(F.concat_ws("/", F.lit("work"), "sub_id", "task_id", default_name).alias("path"),
                       F.when(blank, F.col("content")).otherwise(F.concat(F.lit("# start\n"), "content")).alias("content"),
                       (k != 6).alias("readable"), (default_name.isNotNull() & (k != 8)).alias("there"))
    f = rows.select("sub_id", F.explode(F.array(explicit, default)).alias("f")).select("sub_id", "f.*").where("there")
    if raw:
        data = F.col("content").cast("binary")
        content = F.when(F.col("readable"), data).otherwise(F.concat(data, F.unhex(F.lit("FF"))))
    else:
        content = F.when(F.col("readable"), F.col("content"))
    return f.select("sub_id", "path", content.alias("content"), "readable")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sub_id, ts, http_status, transport_error, body): one service reply per event."""
    return replies(table(spark, sf_dir, "events").select("event_id", "ts", "event_type"))


def replies(e: DataFrame, *keep: str) -> DataFrame:
    """The service replies of events (event_id, ts, event_type), batch or stream, with the columns ``keep``."""
    eid, et = F.col("event_id"), F.col("event_type")
    k = eid % 20
    status = F.when(k == 0, F.lit(500)).when(k == 1, F.lit(None).cast("int")).otherwise(F.lit(200))
    err = F.when(k == 1, F.lit("timeout"))
    verdict = F.when(et == "error", F.lit("error")).otherwise(F.lit("success"))
    body = (F.when(k == 0, F.lit("oops"))
            .when(k == 1, F.lit(None).cast("string"))
            .when(k == 2, F.lit("not json"))
            .when(k == 3, F.lit("[1]"))
            .when(k == 4, F.lit('{"status":"success","message":1}'))
            .when(k == 5, F.lit('{"status":"ok","message":"m"}'))
            .when(k == 6, F.lit('{"status":"error","message":""}'))
            .when(k == 7, F.lit('{"status":"success"}'))
            .when(k == 8, F.lit(""))
            .when(k == 9, F.lit('{"status":["success"],"message":"m"}'))
            .when(k == 10, F.lit('{"status":"success","message":null}'))
            .when(k == 11, F.lit("null"))
            .when(k == 12, F.lit("null x"))                     # text after a scalar
            .when(k == 13, F.lit('"a" b'))
            .when(k == 14, F.lit('\ufeff{"status":"success","message":"bom"}'))
            .when(k == 15, F.lit("-1.5e3"))
            .when(k == 16, F.lit("1 2"))
            # long texts with escapes, and each key twice: the last counts
            .when(k == 17, F.concat(F.lit('{"message":"first '), F.repeat(F.lit("ab\\n"), 500), F.lit('","status":"error","more":{"message":"'),
                                    F.repeat(F.lit("inner "), 300), F.lit('"},"message":"'), et, F.repeat(F.lit(' \\"q\\" xyz'), 300),
                                    F.lit('","status":"'), verdict, F.lit('"}')))
            .when(k == 18, F.concat(F.lit('{"status":"success","message":"'), F.repeat(F.lit("long "), 300), F.lit('","message":2}')))
            .otherwise(F.concat(F.lit('{"status":"'), verdict, F.lit('","message":"'),
                                et, F.lit('"}'))))
    return e.select(eid.alias("sub_id"), "ts", *keep, status.cast("int").alias("http_status"),
                    err.alias("transport_error"), body.alias("body"))


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, value): per-submission service-address overrides.

    One per page, keyed by page id; an empty value is a real override.
    """
    return endpoints(spark, sf_dir).select(F.col("req_id").alias("key"),
                                           F.col("raw_url").alias("value"))


def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, base_url, student_key): both settings' overrides of each page id; either may be absent (null) or empty."""
    key = F.col("req_id")
    student = F.when(key % 5 == 0, F.lit(None).cast("string")).when(key % 5 == 1, F.lit("")).otherwise(F.concat(F.lit("k"), _s(key)))
    return endpoints(spark, sf_dir).select(key.alias("key"), F.when(key % 7 != 3, F.col("raw_url")).alias("base_url"), student.alias("student_key"))
