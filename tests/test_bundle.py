"""A1, J2, S2, A3, A2, P6, J1, X4 on hand-made submission tables."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatehouse.operators import (artifact_kind, assemble_bundle, check_arity, first_failure,
                                 reconcile, request_json, resolve_paths, screen,
                                 submission_headers)
from gatehouse.plans import fixtures as fx

TASKS = [(0, "single", "/s", ["realization.py"], False), (1, "bundle", "/b", ["a.py", "b.sh", "dag.py"], True),
         (2, "nodefault", "/n", None, False), (3, "closed", None, ["realization.py"], False),
         (4, "bundle1", "/1", ["only.py"], True)]


def tasks(spark):
    return spark.createDataFrame(TASKS, fx.TASK_SCHEMA)


def headers(spark, rows):
    return spark.createDataFrame(rows, "sub_id bigint, student_id string, task_id string")


def explicit(spark, rows):
    return spark.createDataFrame(rows, "sub_id bigint, pos bigint, path string")


def test_arity_rules(spark):
    h = headers(spark, [(1, "u", "single"), (2, "u", "single"), (3, "u", "bundle"), (4, "u", "bundle"),
                        (5, "u", "bundle"), (6, "u", "nodefault"), (7, "u", "nodefault"), (8, "u", "unknown"), (9, "u", "bundle1"), (10, "u", "bundle1")])
    e = explicit(spark, [(2, 0, "/x"), (2, 1, "/y"), (4, 0, "/a"), (4, 1, "/b"), (4, 2, "/c"),
                         (5, 0, "/a"), (7, 0, "/z"), (1, 0, None), (10, 0, "/a"), (10, 1, "/b")])
    got = {r.sub_id: (r.n_explicit, r.arity_ok, r.has_files)
           for r in check_arity(h, e, tasks(spark)).collect()}
    assert got == {1: (0, True, True), 2: (2, False, True), 3: (0, True, True), 4: (3, True, True),
                   5: (1, False, True), 6: (0, True, False), 7: (1, True, True), 8: (0, True, False), 9: (0, True, True), 10: (2, False, True)}


def test_explicit_replaces_defaults_by_position(spark):
    h = headers(spark, [(1, "u", "bundle"), (2, "u", "bundle"), (3, "u", "single")])
    e = explicit(spark, [(1, 0, "/in/x"), (1, 1, "/in/y"), (1, 2, "/in/z")])
    m = resolve_paths(check_arity(h, e, tasks(spark)), e)
    got = sorted((r.sub_id, r.pos, r.name, r.path, r.source) for r in m.collect())
    assert got == [
        (1, 0, "a.py", "/in/x", "explicit"), (1, 1, "b.sh", "/in/y", "explicit"),
        (1, 2, "dag.py", "/in/z", "explicit"),
        (2, 0, "a.py", "work/2/bundle/a.py", "default"), (2, 1, "b.sh", "work/2/bundle/b.sh", "default"),
        (2, 2, "dag.py", "work/2/bundle/dag.py", "default"),
        (3, 0, "realization.py", "work/3/single/realization.py", "default")]


def test_reconcile_and_first_failure(spark):
    manifest = spark.createDataFrame(
        [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "a"), (3, 0, "a"), (3, 1, "b")],
        "sub_id bigint, pos bigint, name string")
    files = spark.createDataFrame(
        [(1, 0, "x", True), (1, 1, None, False), (1, 2, " ", True), (2, 0, "ok", True), (3, 0, "\t", True)],
        "sub_id bigint, pos bigint, content string, readable boolean")
    r = reconcile(manifest, files, ["sub_id", "pos"])
    states = {(x.sub_id, x.pos): x.state for x in r.collect()}
    assert states == {(1, 0): "ok", (1, 1): "unreadable", (1, 2): "blank", (2, 0): "ok",
                      (3, 0): "blank", (3, 1): "missing_or_empty"}
    ff = {x.sub_id: (x.fail_pos, x.fail_name, x.fail_state) for x in first_failure(r).collect()}
    assert ff == {1: (1, "b", "unreadable"), 2: (None, None, None), 3: (0, "a", "blank")}


def test_path_decides_which_file_counts(spark):
    manifest = spark.createDataFrame([(1, 0, "a", "in/x"), (2, 0, "a", "work/2/a")], "sub_id bigint, pos bigint, name string, path string")
    files = spark.createDataFrame([("in/x", "explicit", True), ("work/1/a", "default of 1", True), ("work/2/a", "default of 2", True)],
                                  "path string, content string, readable boolean")
    got = {r.sub_id: r.content for r in reconcile(manifest, files, with_content=True).collect()}
    assert got == {1: "explicit", 2: "default of 2"}


def test_bundle_order_and_repeated_name(spark):
    files = spark.createDataFrame(
        [(1, 2, "b", "B"), (1, 0, "a", "A1\r\n"), (1, 1, "a", "A2"), (2, 0, "only", "text"), (3, 0, "a", "x"), (3, 1, "b", None)],
        "sub_id bigint, pos bigint, name string, content string")
    got = {r.sub_id: r for r in assemble_bundle(files).collect()}
    # like dict(zip(names, texts)): first position of a name, last text
    # byte-equal to the client's json.dumps(dict(zip(names, texts)), ensure_ascii=False)
    assert got[1].solution == json.dumps({"a": "A2", "b": "B"}, ensure_ascii=False)
    assert list(json.loads(got[1].solution)) == ["a", "b"]
    assert got[1].single_text is None
    assert got[2].single_text == "text" and got[2].solution == '{"only": "text"}'
    assert got[3].solution is None                      # a missing text: no bundle


def test_large_bundle_is_assembled(spark):
    files = spark.createDataFrame([(1, 0, "a", "x" * 3_000_000), (1, 1, "b", "y")],
                                  "sub_id bigint, pos bigint, name string, content string")
    r = assemble_bundle(files).first()
    assert r.bundle_bytes == 3_000_001 and len(json.loads(r.solution)["a"]) == 3_000_000


def test_request_json(spark):
    df = spark.createDataFrame([(" u1\t", '{"a":"é\\n"}')], "s string, sol string")
    req = df.select(request_json("s", "sol")).first()[0]
    assert json.loads(req) == {"student_id": "u1", "student_solution": '{"a":"é\\n"}'}


def test_artifact_kind(spark):
    files = spark.createDataFrame([("4.11.1", "realization.py"), ("4.11.2", "realization.py"),
                                   ("1.1.1", "realization.py"), ("1.1.1", "realization.txt"),
                                   ("4.12.1", "dag.py"), ("5.4.2", "run_jobs.sh")],
                                  "task_id string, name string")
    got = [(r.task_id, r.name, r.kind) for r in
           artifact_kind(files, fx.kinds(spark), fx.exceptions(spark)).orderBy("task_id", "name").collect()]
    assert got == [("1.1.1", "realization.py", "python_code"), ("1.1.1", "realization.txt", "expected_output"),
                   ("4.11.1", "realization.py", "shell_command"), ("4.11.2", "realization.py", "shell_command"),
                   ("4.12.1", "dag.py", "dag"), ("5.4.2", "run_jobs.sh", None)]


def test_screen_precedence(spark):
    # each submission fails several rules; the first in client order wins
    files = spark.createDataFrame([
        (1, " ", "closed"), (2, " ", "single"), (3, "u", "nodefault"), (4, " ", "single"), (5, " ", "single"),
        (6, "u", "bundle"), (7, "u", "bundle"), (8, "u", "single"), (9, "u", "bundle1"), (10, "u", "single")],
        "sub_id bigint, student_id string, task_id string")
    stored = spark.createDataFrame([
        ("work/6/bundle/a.py", "x", True), ("work/6/bundle/b.sh", "  ", True), ("work/6/bundle/dag.py", "", True),
        ("work/7/bundle/a.py", "x", True), ("work/7/bundle/b.sh", "y", True),          # third file missing
        ("work/8/single/realization.py", "fine", True), ("work/9/bundle1/only.py", "one", True),
        ("work/10/single/realization.py", "the default", True), ("/mine", "the explicit", True)],
        "path string, content string, readable boolean")
    e = explicit(spark, [(2, 0, "/a"), (2, 1, "/b"), (10, 0, "/mine")])
    overrides = spark.createDataFrame([(4, "ftp://h")], "key bigint, value string")
    out = screen(files, e, tasks(spark), overrides, "https://ok.example", stored, collect_bundles=True).collect()
    assert {r.sub_id: (r.reason, r.fail_pos) for r in out} == {
        1: ("no_endpoint", None), 2: ("bad_arity", None), 3: ("no_default_file", None), 4: ("bad_address", None),
        5: ("blank_student", None), 6: ("blank", 1), 7: ("missing_or_empty", 2), 8: (None, None), 9: (None, None),
        10: (None, None)}
    by = {r.sub_id: r for r in out}
    assert by[8].single_text == "fine" and not by[8].bundle
    assert by[9].solution == '{"only.py": "one"}' and by[9].bundle       # a bundle of one file is a map
    assert by[10].single_text == "the explicit"


def test_headers_one_row_per_submission(spark):
    files = spark.createDataFrame([(1, "u", "t", 0), (1, "u", "t", 1), (2, "v", "t", 0)],
                                  "sub_id bigint, student_id string, task_id string, pos bigint")
    assert submission_headers(files).count() == 2


def test_bundle_text_matches_python_json(spark):
    texts = ['é "q" \\ back', "tab\tnl\nx", "emoji 😀 ok", "", "/slash"]
    files = spark.createDataFrame([(1, i, f"n{i}.py", t) for i, t in enumerate(texts)],
                                  "sub_id bigint, pos bigint, name string, content string")
    got = assemble_bundle(files, normalise=False).first().solution
    assert got == json.dumps({f"n{i}.py": t for i, t in enumerate(texts)}, ensure_ascii=False)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(
    ["a", "é", "😀", "\\", '"', "/", "u", "0", "1", "F", "\n", "\t", "\r", "\b", "\f"]
    + [chr(c) for c in range(0, 32)] + ["\x7f", "\u2028"]), max_size=15), min_size=1, max_size=6))
def test_json_string_matches_python(spark, texts):
    from gatehouse.operators.bundle import json_string
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(json_string(F.col("v"))).collect()]
    assert got == [json.dumps(t, ensure_ascii=False) for t in texts]


def test_out_of_range_keys_do_not_fail(spark):
    # ANSI mode: a position or id outside int range must not fail the job
    h = headers(spark, [(1, "u", "bundle")])
    e = explicit(spark, [(1, 0, "/a"), (1, 1, "/b"), (1, 5_000_000_000, "/c")])
    m = resolve_paths(check_arity(h, e, tasks(spark)), e)
    got = sorted((r.pos, r.name) for r in m.collect())
    assert got == [(0, "a.py"), (1, "b.sh"), (5_000_000_000, None)]
