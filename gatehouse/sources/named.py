"""S1 by manifest: files opened by the paths a table names, and no others.

A folder scan lists every file on the driver and opens all of them. Here the
paths are rows: they are dealt to tasks, and each task asks the store for the
size of its own paths and opens those that hold something. So files of
rejected submissions are never touched, no listing grows on the driver, and a missing
file and an empty one are told apart. Lost tasks are re-run and read again.

Stores are those pyarrow opens by address (``file``, ``hdfs``, ``s3``, ``gs``, ...).
"""

from __future__ import annotations

import posixpath
import re
import sys
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # workers need pyarrow, not this package

FILES_PER_TASK = 2000
BATCH_BYTES = 16 << 20


def open_store(root: str):
    """(file system, base path) of an address or a plain path."""
    from pyarrow import fs
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", root):
        store, base = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", root))
    else:
        store, base = fs.LocalFileSystem(), root
    return store, base.rstrip("/")


def below(base: str, path: str) -> str | None:
    """Where ``path`` lies under ``base``; null for one that leads out of it."""
    full = posixpath.normpath(posixpath.join(base, path.lstrip("/")))
    return full if full.startswith(base + "/") else None


def parts_for(df: DataFrame, per_task: int) -> int:
    """Tasks for the rows of a written table: so many rows each, and at least one a core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // per_task))


def file_status(wanted: DataFrame, root: str, path: str = "path", per_task: int = FILES_PER_TASK) -> DataFrame:
    """``wanted`` with ``exists`` and ``n_bytes`` (null if missing or no plain file): a listing of
    just these paths, made by the tasks. Zero-byte files have a row like any other."""
    return _visited(wanted, root, path, per_task, read=False).drop("data")


def read_named(wanted: DataFrame, root: str, path: str = "path", per_task: int = FILES_PER_TASK) -> DataFrame:
    """``wanted`` with ``exists``, ``n_bytes``, ``content`` and ``readable`` of the file each ``path`` names.

    Files lie under ``root``; a path that leads out of it, a null one and one with
    nothing there are missing (``exists`` false, the rest null). Text is strict UTF-8 and whole, as
    stored; a file that is none, may not be opened, or is a folder has ``readable`` false and null
    ``content``. A zero-byte file is read as empty text without being opened. Any other
    failure of the store fails the task, which Spark tries again. Repeated paths are
    read once a row; columns of the names made here are replaced.

    ``wanted`` should be a written table or a cheap query, as its rows are counted first.
    """
    got = _visited(wanted, root, path, per_task, read=True)
    text = F.col("data").cast("string")
    readable = F.col("data").isNotNull() & F.is_valid_utf8(text)
    return (got.withColumn("content", F.when(readable, text))
            .withColumn("readable", F.when(F.col("exists"), readable)).drop("data"))


def _visited(wanted: DataFrame, root: str, path: str, per_task: int, read: bool) -> DataFrame:
    import pyarrow as pa
    made = ("exists", "n_bytes", "data", "content", "readable")
    wanted = wanted.select(*(F.col(f"`{c}`") for c in wanted.columns if c not in made))
    names = wanted.columns
    at = names.index(path)
    schema = (wanted.withColumn("exists", F.lit(None).cast("boolean")).withColumn("n_bytes", F.lit(None).cast("bigint"))
              .withColumn("data", F.lit(None).cast("binary")).schema)

    def visit(batches: Iterator) -> Iterator:
        from pyarrow.fs import FileType
        store, base = open_store(root)
        for batch in batches:
            rows, size, since = [], 0, 0

            def out(to: int):
                done = batch.slice(since, to - since)
                cols = list(zip(*rows))
                return pa.RecordBatch.from_arrays(
                    [*done.columns, pa.array(cols[0], pa.bool_()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
                    names=[*names, "exists", "n_bytes", "data"])

            for i, p in enumerate(batch.column(at).to_pylist()):
                full = None if p is None else below(base, p)
                info = store.get_file_info(full) if full else None
                if info is None or info.type == FileType.NotFound:
                    rows.append((False, None, None))
                elif info.type != FileType.File:
                    rows.append((True, None, None))
                elif not read or not info.size:
                    rows.append((True, info.size, None if info.size else b""))
                else:
                    try:
                        with store.open_input_stream(full) as f:
                            data = f.read()
                        rows.append((True, len(data), data))
                        size += len(data)
                    except FileNotFoundError:       # went meanwhile
                        rows.append((False, None, None))
                    except PermissionError:
                        rows.append((True, info.size, None))
                if size >= BATCH_BYTES:
                    yield out(i + 1)
                    rows, size, since = [], 0, i + 1
            if rows:
                yield out(len(batch))

    # an explicit count: the work is in the files, not in the rows, so AQE must not join the tasks
    return wanted.repartition(parts_for(wanted, per_task), path).mapInArrow(visit, schema)


def write_named(df: DataFrame, root: str, path: str = "path", content: str = "content", per_task: int = FILES_PER_TASK) -> int:
    """Each row's ``content`` as one file at its ``path`` under ``root``, byte for byte; the number of files.

    A file appears whole: it is written beside its place and then renamed, so a
    task that runs twice leaves the same. A path that leads out of ``root`` fails the job.
    """
    import pyarrow as pa
    rows = df.select(F.col(f"`{path}`").alias("path"), F.col(f"`{content}`").cast("binary").alias("data"))
    n = parts_for(rows, per_task)

    def put(batches: Iterator) -> Iterator:
        store, base = open_store(root)
        renames, made, count = store.type_name in ("local", "hdfs"), set(), 0
        for batch in batches:
            for p, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                full = below(base, p)
                if full is None:
                    raise ValueError(f"{p!r} leads out of the folder")
                parent = posixpath.dirname(full)
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                to = f"{full}.{uuid.uuid4().hex}" if renames else full
                with store.open_output_stream(to) as f:
                    f.write(data or b"")
                if renames:
                    store.move(to, full)
                count += 1
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["n"])

    return rows.repartition(n, "path").mapInArrow(put, "n bigint").agg(F.sum("n")).first()[0] or 0
