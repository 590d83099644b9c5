"""Submission-level operators: arity (A1), path resolution (J2), reconciliation
of expected files with read files (S2), first failing file (A3), bundle
assembly (A2) and the request object (P6).

All grouping is by ``sub_id``; aggregates are partial (map-side) before the
shuffle. A submission sends no more files than its task expects (A1 checks
that before J2 builds the list), so a collected bundle has a few entries; one
that is too large for a Spark row fails the job, it is never cut or left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehouse.functions.text import is_blank, normalise_newlines, strip

ENTRY_ARRAY = "array<struct<pos:bigint,name:string,path:string,source:string>>"


def submission_headers(files: DataFrame) -> DataFrame:
    """(sub_id, student_id, task_id): one row per submission from per-file rows.

    Both values are constant within a submission; ``max`` keeps the aggregate
    deterministic and partial.
    """
    return files.groupBy("sub_id").agg(F.max("student_id").alias("student_id"),
                                        F.max("task_id").alias("task_id"))


def check_arity(headers: DataFrame, explicit: DataFrame, tasks: DataFrame) -> DataFrame:
    """A1: header columns + (endpoint, expected, bundle, n_explicit, arity_ok, has_files).

    ``tasks`` says by ``bundle`` whether a task sends a bundle (also one of a single
    file). A bundle takes no explicit paths or exactly one per expected file;
    any other task takes at most one. ``has_files`` is false when nothing was named and
    the task has no default file, which the client rejects next.
    ``explicit`` is (sub_id, pos, path) with ``path`` null when none was named.
    """
    counts = explicit.groupBy("sub_id").agg(F.count("path").alias("n_explicit"))
    t = tasks.select("task_id", "endpoint", "expected", "bundle")
    n = F.coalesce(F.col("n_explicit"), F.lit(0)).cast("bigint")
    expected = F.col("expected")
    arity_ok = (F.when(F.coalesce("bundle", F.lit(False)), (n == 0) | (n == F.size(expected)))
                .otherwise(n <= 1))
    return (headers.join(t, "task_id", "left").join(counts, "sub_id", "left")
            .select(*headers.columns, "endpoint", "expected", F.coalesce("bundle", F.lit(False)).alias("bundle"),
                    n.alias("n_explicit"), arity_ok.alias("arity_ok"),
                    ((n > 0) | expected.isNotNull()).alias("has_files")))


def resolve_paths(arity: DataFrame, explicit: DataFrame, task_root: str = "work",
                  build: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """(sub_id, task_id, [carry], pos, name, path, source): the files sent.

    If a submission names any paths, they replace *all* default files and pair
    with the expected names by position (their own names are ignored);
    otherwise the expected files are taken from the submission's own copy of the
    task folder, ``<task_root>/<sub_id>/<task_id>/<name>``. ``arity`` is the output of :func:`check_arity`.

    One left join with the named paths and one ``explode``: a submission
    without named paths comes out of the join once and expands to its default
    files. With ``build`` (a boolean column), submissions where it is false get
    no files but one placeholder row with null ``pos`` (so later aggregates
    still see them without a second pass over ``arity``).
    """
    carry = carry or []
    named = explicit.where(F.col("path").isNotNull()).select(
        F.col("sub_id").alias("_nsub"), F.col("pos").alias("_npos"), F.col("path").alias("_npath"))
    cond = F.col("sub_id") == F.col("_nsub")
    if build is not None:
        cond = cond & build
    j = arity.join(named, cond, "left").drop("_nsub")

    def entry(pos, name, path, source):
        return F.struct(pos.cast("bigint").alias("pos"), name.alias("name"),
                        path.alias("path"), F.lit(source).alias("source"))

    expected = F.col("expected")
    from_named = F.array(entry(F.col("_npos"),
                               F.try_element_at(expected, (F.col("_npos") + 1).try_cast("int")),
                               F.col("_npath"), "explicit"))
    from_defaults = F.transform(F.coalesce(expected, F.array().cast("array<string>")),
                                lambda x, i: entry(i, x, F.concat_ws("/", F.lit(task_root), F.col("sub_id").cast("string"),
                                                                        F.col("task_id"), x),
                                                   "default"))
    entries = F.when(F.col("_npath").isNotNull(), from_named).otherwise(from_defaults)
    if build is None:
        out = j.select("sub_id", "task_id", *carry, F.explode(entries).alias("_e"))
    else:
        entries = F.when(build, entries).otherwise(F.array().cast(ENTRY_ARRAY))
        out = j.select("sub_id", "task_id", *carry, F.explode_outer(entries).alias("_e"))
    return out.select("sub_id", "task_id", *carry, "_e.pos", "_e.name", "_e.path", "_e.source")


def reconcile(manifest: DataFrame, files: DataFrame, keys: list[str] | None = None,
              with_content: bool = False, listed: bool = False) -> DataFrame:
    """Every expected file with its read state, in manifest order.

    The file named by the manifest's ``path`` is the one that counts (``keys``:
    other join columns). ``files`` carries ``content`` and ``readable``. With ``listed``
    it has a row for every file there is, zero-byte ones included (as
    ``sources.read_named`` gives): a manifest row without one is ``missing`` and a zero-byte file
    ``empty``. From a folder scan, which yields no row for zero-byte files, either is
    ``missing_or_empty``. Then ``unreadable`` (not UTF-8), ``blank`` (white space only) and ``ok``.

    The blank check runs on the file side before the join, so only two flags
    per file cross the shuffle; the text itself is carried only with
    ``with_content`` (for assembling bundles).
    """
    keys = keys or ["path"]
    cols = [*keys, F.col("readable").alias("_readable"), is_blank("content").alias("_blank"),
            (F.col("content") == "").alias("_empty")]
    if with_content:
        cols.append("content")
    j = manifest.join(files.select(*cols), keys, "left")
    state = (F.when(F.col("_readable").isNull(), F.lit("missing" if listed else "missing_or_empty"))
             .when(~F.col("_readable"), F.lit("unreadable"))
             .when(F.lit(listed) & F.col("_empty"), F.lit("empty"))
             .when(F.col("_blank"), F.lit("blank"))
             .otherwise(F.lit("ok")))
    return j.withColumn("state", state).drop("_readable", "_blank", "_empty")


def first_failure(reconciled: DataFrame) -> DataFrame:
    """A3: (sub_id, fail_pos, fail_name, fail_state) of the first bad file.

    Files are checked in position order and the first bad one names the
    error; ``min`` over (pos, name, state) among bad files gives it with a
    partial aggregate. Submissions whose files are all fine get nulls.
    """
    bad = F.when(F.col("state") != "ok", F.struct("pos", "name", "state"))
    return (reconciled.groupBy("sub_id").agg(F.min(bad).alias("f"))
            .select("sub_id", F.col("f.pos").alias("fail_pos"),
                    F.col("f.name").alias("fail_name"), F.col("f.state").alias("fail_state")))


def assemble_bundle(files: DataFrame, normalise: bool = True) -> DataFrame:
    """A2: (sub_id, bundle_bytes, solution, single_text).

    ``files`` are the files a submission sends (J2 after A1, with their texts).
    ``solution`` is the name -> text map as JSON; ``single_text`` is the text
    itself when the submission has exactly one file. Both are null where a
    text is missing.

    Keys keep position order; a repeated name keeps its first position and
    its last text (needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN``).
    """
    content = normalise_newlines("content") if normalise else F.col("content")
    texts = files.select("sub_id", "pos", "name", content.alias("content"))
    agg = texts.groupBy("sub_id").agg(
        F.sum(F.octet_length("content")).cast("bigint").alias("bundle_bytes"),
        F.bool_and(F.col("content").isNotNull()).alias("_complete"),
        F.collect_list(F.struct("pos", "name", "content")).alias("_entries"))
    solution, single = bundle_solution(F.col("_entries"))
    return agg.select("sub_id", "bundle_bytes", F.when(F.col("_complete"), solution).alias("solution"),
                      F.when(F.col("_complete"), single).alias("single_text"))


# Control characters Spark escapes as \uXXXX with upper-case hex digits,
# where Python writes lower case (all others get the same escape in both).
_UPPER_HEX_CONTROLS = ["000B", "000E", "000F", "001A", "001B", "001C", "001D", "001E", "001F"]


def json_string(c: Column) -> Column:
    """A string as a JSON string literal, escaped as Python's ``json.dumps``.

    Quotes, backslashes and control characters are escaped, non-ASCII is kept.
    The few escapes whose hex case differs are rewritten, only in texts that
    contain such a character; the look-behind skips an escaped backslash
    followed by the letters of an escape.
    """
    text = F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]\z", "")
    fixed = text
    for code in _UPPER_HEX_CONTROLS:
        fixed = F.regexp_replace(fixed, r"(?<!\\)((?:\\\\)*+)\\u" + code, r"$1\\u" + code.lower())
    return F.when(c.rlike("[\x0b\x0e\x0f\x1a-\x1f]"), fixed).otherwise(text)


def python_json_object(m: Column) -> Column:
    """A string -> string map as JSON text with Python's default separators.

    ``json.dumps(d, ensure_ascii=False)`` writes ``{"a": "x", "b": "y"}``: a
    blank after each comma and colon, keys in insertion order, non-ASCII as
    is. The request carries this text inside a string, so it is built with the
    same separators rather than Spark's compact form.
    """
    pairs = F.transform(F.map_entries(m),
                        lambda e: F.concat(json_string(e["key"]), F.lit(": "), json_string(e["value"])))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def bundle_solution(entries: Column) -> tuple[Column, Column]:
    """(bundle JSON, single text) from a collected array of (pos, name, content).

    The JSON map keeps position order; a file without a name (single-file task
    with no default name) has no map key, so such a list gives no bundle.
    """
    ordered = F.sort_array(entries)
    as_map = F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["name"], e["content"])))
    solution = python_json_object(as_map)
    named = F.forall(entries, lambda e: e["name"].isNotNull())
    single = F.when(F.size(entries) == 1, ordered[0]["content"])
    return F.when(named, solution), single


def request_json(student_id: Column | str, solution: Column | str) -> Column:
    """The request object; a bundle is JSON text inside a JSON string.

    The student key is sent stripped (P1). Spark writes compact UTF-8 JSON;
    equal as JSON (not as bytes) to Python's default spacing and escaping.
    """
    sid = strip(student_id)
    sol = F.col(solution) if isinstance(solution, str) else solution
    return F.to_json(F.struct(sid.alias("student_id"), sol.alias("student_solution")))
