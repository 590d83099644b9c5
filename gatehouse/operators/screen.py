"""The screen -- one reason code per submission, first rule wins --
and, on the same pass, the bundle of every submission that may be sent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehouse.functions.text import _col, is_blank, normalise_newlines
from gatehouse.functions.urls import valid_base_url
from gatehouse.operators.bundle import (bundle_solution, check_arity, reconcile, resolve_paths,
                                        submission_headers)
from gatehouse.operators.overlay import overlay
from gatehouse.session import shared_table

# The reason codes, in the order the client checks them. File
# reasons (``missing``, ``empty``, ``missing_or_empty``, ``unreadable``, ``blank``) come last, for the
# first bad file in position order.
REASONS = ("no_endpoint", "bad_arity", "no_default_file", "bad_address", "blank_student")


def endpoint_available(endpoint: Column | str) -> Column:
    """a task can be checked once it has an endpoint; empty counts."""
    return _col(endpoint).isNotNull()


def screen(files: DataFrame, explicit: DataFrame, tasks: DataFrame,
           overrides: DataFrame, default_base_url: str, contents: DataFrame | Callable[[DataFrame], DataFrame],
           collect_bundles: bool = False, path: str = "path", prune: bool = False, listed: bool = False,
           keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """One row per submission.

    Columns: sub_id, task_id, student_id, endpoint, expected, bundle, n_explicit,
    base_url, reason (null = may be sent), fail_pos; with ``collect_bundles``
    also solution (JSON map) and single_text.

    ``files``: (sub_id, student_id, task_id, ...) per file; ``explicit``: (sub_id,
    pos, path|null); ``overrides``: per-submission service address (key =
    sub_id); ``contents``: the files as read, (``path``, content, readable), or a function
    that reads them: it is given the paths (``path``) of the files to be sent, once each, and returns
    that table. ``keys``: how files are found; with ``("sub_id", "path")`` the files' table has the submission
    too, and tables bucketed by it need no exchange (see ``plans.colocated``). ``listed``: zero-byte files have rows too (see :func:`reconcile`).

    Plan: header rules on one row per submission; the file manifest is built
    only for submissions that pass them (others keep one placeholder row) and
    joined with the files by path. With a reading function the manifest is written first, and
    nothing of a rejected submission is opened. With ``prune`` (for a scan of many more files
    than are sent) the files are first cut down to the manifest's paths by a
    semi-join, so texts that nobody sends go no further than the scan. One
    aggregate by
    submission gives the first failure and, when asked, the bundle.
    """
    headers = submission_headers(files)
    arity = check_arity(headers, explicit, tasks)
    addressed = overlay(arity, overrides, "sub_id", default_base_url, out="base_url")
    header_reason = (F.when(~endpoint_available("endpoint"), F.lit(REASONS[0]))
                     .when(~F.col("arity_ok"), F.lit(REASONS[1]))
                     .when(~F.col("has_files"), F.lit(REASONS[2]))
                     .when(~valid_base_url("base_url"), F.lit(REASONS[3]))
                     .when(is_blank("student_id") | F.col("student_id").isNull(), F.lit(REASONS[4])))
    checked = addressed.withColumn("_header_reason", header_reason)

    carry = ["student_id", "endpoint", "expected", "bundle", "n_explicit", "base_url", "_header_reason"]
    manifest = resolve_paths(checked, explicit, build=F.col("_header_reason").isNull(), carry=carry)

    if callable(contents):
        manifest = shared_table(manifest, "screen-manifest")
        contents = contents(manifest.where("path is not null").select(F.col("path").alias(path)).distinct())
    needed = contents.where("readable is not null").select(*(k for k in keys if k != "path"), F.col(path).alias("path"), "content", "readable")
    if prune:
        named = manifest.where(F.col("path").isNotNull()).select(F.col("path").alias("_wanted"))
        needed = needed.join(named, F.col("path") == F.col("_wanted"), "left_semi")
    rows = reconcile(manifest, needed, list(keys), with_content=collect_bundles, listed=listed)
    state = F.when(F.col("pos").isNotNull(), F.col("state"))   # placeholder rows: no file
    bad = F.when(state != "ok", F.struct("pos", "name", state.alias("state")))
    aggs = [F.max(c).alias(c) for c in ("task_id", *carry)] + [F.min(bad).alias("_bad")]
    if collect_bundles:
        entry = F.struct("pos", "name", normalise_newlines("content").alias("content"))
        aggs.append(F.collect_list(F.when(state == "ok", entry)).alias("_entries"))
    agg = rows.groupBy("sub_id").agg(*aggs)

    reason = F.coalesce("_header_reason", "_bad.state")
    out = [F.col("sub_id"), "task_id", "student_id", "endpoint", "expected", "bundle", "n_explicit", "base_url",
           reason.alias("reason"),
           F.when(F.col("_header_reason").isNull(), F.col("_bad.pos")).cast("bigint").alias("fail_pos")]
    if collect_bundles:
        solution, single = bundle_solution(F.col("_entries"))
        out += [F.when(reason.isNull(), solution).alias("solution"), F.when(reason.isNull(), single).alias("single_text")]
    return agg.select(*out)
