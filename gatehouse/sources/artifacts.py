"""Whole-file text scan, strict UTF-8, one file = one record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_artifacts(spark: SparkSession, path: str, glob: str | None = None,
                   recursive: bool = False) -> DataFrame:
    """(path, [partition columns], n_bytes, content, readable) per file.

    Reads bytes with the ``binaryFile`` source (one row per file, files are
    split across tasks by the file listing, never merged) and decodes them as
    strict UTF-8: a file with an invalid byte sequence is *unreadable* -- its
    ``content`` is null -- rather than decoded with replacement characters. A
    leading byte-order mark is kept, as Python's ``utf-8`` codec does.
    Newlines are left as stored (see ``normalise_newlines``). A file too large
    for one Spark row fails the scan.

    Zero-byte files yield no row in Spark's file sources; reconcile against
    the expected files (:func:`gatehouse.operators.reconcile`) to catch them.
    Partition folders (``key=value``) become columns unless ``recursive``; their
    values stay text as written (``007`` is not ``7``).
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    raw = reader.load(path)
    keep = [c for c in raw.columns if c not in ("path", "modificationTime", "length", "content")]
    text = F.col("content").cast("string")
    readable = F.is_valid_utf8(text)
    return raw.select("path", *keep, F.col("length").alias("n_bytes"), F.when(readable, text).alias("content"),
                      readable.alias("readable"))
