"""Request and verdict sinks (written through Spark's commit protocol,
so a lost executor's task is simply re-run)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
WRITERS = 8         # files a task holds open: one an outcome, and room for a null


def write_requests(df: DataFrame, path: str, column: str = "request") -> None:
    """S3: one JSON request object per line (JSON Lines text).

    The request text is already JSON (see ``request_json``); control
    characters inside it are escaped, so each request is exactly one line.
    """
    df.select(column).write.mode("errorifexists").text(path)


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Inside, a task that writes by a column keeps up to ``WRITERS`` files open instead of
    sorting its rows; only rows of further values are sorted."""
    before = spark.conf.get(_WRITERS, None)
    spark.conf.set(_WRITERS, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.unset(_WRITERS) if before is None else spark.conf.set(_WRITERS, before)


def write_verdicts(df: DataFrame, path: str, partition_by: str = "outcome") -> None:
    """Verdicts as Parquet, one folder per outcome for pruned reads.

    Rows are rebalanced by outcome first: AQE splits a large outcome into files of its
    advisory size and gives a small one a single file, where each task would
    else leave one file an outcome. That size is one of compressed rows, which may be many
    times as large in memory, so they are not sorted by outcome (see ``open_writers``).
    """
    with open_writers(df.sparkSession):
        df.hint("rebalance", F.col(partition_by)).write.mode("errorifexists").partitionBy(partition_by).parquet(path)


def write_artifacts(df: DataFrame, path: str, keys: list[str], column: str = "content",
                    mode: str = "errorifexists") -> None:
    """Write one text file per row under ``key=value`` folders (the reverse of S1).

    Each file holds the row's text followed by one newline (text sink line
    end). Rows are clustered by their keys first, so each task opens one file
    at a time.
    """
    # an explicit count: file creation, not bytes, is the cost here, so keep
    # every core busy (AQE would coalesce small data into a few tasks)
    n = df.sparkSession.sparkContext.defaultParallelism * 2
    (df.select(*keys, column).repartition(n, *keys).sortWithinPartitions(*keys)
     .write.mode(mode).partitionBy(*keys).text(path))
