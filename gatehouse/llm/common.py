"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

from gatehouse.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark from whatever store ``sf_dir`` names."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage: later stages survive the loss of any executor, and a
    frame that is used twice is computed once.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_chunks(data: bytes, size: int) -> Iterator[bytes]:
    """Cut ``data`` into pieces of about ``size`` bytes, at ASCII white space only."""
    start, n = 0, len(data)
    while n - start > size:
        cut = start + size
        ends = [p for p in (data.find(c, cut) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
                if p >= 0]
        if not ends:
            break
        cut = min(ends)
        yield data[start:cut]
        start = cut
    yield data[start:]


_UNEVEN = re.compile(r" (?<=\s )(?:\s|\Z)")
_OPENING = re.compile(r"(?= \S)")


def cut_words(text: str) -> tuple[str, list[str]]:
    """The text's first word and those after it, without the blank before each.

    For patterns of byte-level tokenizers: they always open a piece at a blank that
    a non-space character follows, and at one behind a non-space character. So a
    text is cut at its blanks, unless one stands between two spaces or behind a space at
    the end; then only where a non-space character follows. Words may hold further space.
    """
    if _UNEVEN.search(text):
        first, *rest = _OPENING.split(text)
        return first, [w[1:] for w in rest]
    first, *rest = text.split(" ")
    return first, rest


class Kept(dict):
    """``make`` of each key, made when first asked for. The keys met last are kept: two
    generations of ``size`` at most, none longer than ``longest``."""

    def __init__(self, make: Callable, size: int, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def as_bytes(column) -> Iterable[bytes | None]:
    """UTF-8 bytes of an Arrow string column, without a detour over ``str``."""
    import pyarrow as pa
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()
