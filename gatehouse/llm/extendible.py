"""Sharding by extendible hashing. DataFrame functions only.

A row's hash is read as a string of bits. A bucket is a bit prefix; it is split
on its next bit only while its rows exceed the byte limit, so small buckets
stay where they are and only oversized ones grow deeper. The directory is the
table of final prefixes.

The bytes under all prefixes of up to ``STEP`` more bits come from one partial
aggregate; a bucket's final depth is the smallest at which its sum fits. Rows
in buckets that are still too large then go through the next ``STEP`` bits, so
a round reads only what it has to split. After the 60 bits of the key's hash
follow 60 bits of a hash of the whole row and 60 of a row number: a hot key,
or many copies of one row, are split too. What stays over the limit in the end
is a single row larger than it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatehouse.llm.common import written

BITS = 60               # of each of the three hashes
STEP = 10               # bits read in a round
LIMIT = 1 << 20


def md5_bits(value: Column) -> Column:
    """The first 60 bits of the MD5 of a string, as a long."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 15), 16, 10).cast("bigint")


def shards(df: DataFrame, key: str, size: Column, limit: int = LIMIT, carry: dict[str, Column] | None = None) -> DataFrame:
    """(key, bytes, shard, depth, shard_bytes) and ``carry`` for every row of ``df``.

    ``shard`` is the bit prefix ("" if one shard holds all), ``depth`` its
    length. Null keys hash as a null, null sizes count 0; repeated rows are
    split by a row number, so which of them lands where is not fixed, but how
    many is of no consequence: they are equal. A row larger than ``limit`` ends
    in a shard of its own or with rows of size 0. An empty table gives an empty result.
    """
    extra = [c.alias(f"c_{n}") for n, c in (carry or {}).items()]
    text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null"))
    whole = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))
    base = written(df.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(size.cast("bigint"), F.lit(0)).alias("bytes"),
        md5_bits(text).alias("h0"), md5_bits(F.md5(whole)).alias("h1"),
        md5_bits(F.monotonically_increasing_id().cast("string")).alias("h2"), *extra), "shard-rows")
    kept = [f"c_{n}" for n in (carry or {})]
    names = [F.col(f"c_{n}").alias(n) for n in (carry or {})]
    rows = base.withColumn("prefix", F.lit(""))
    done = None
    for word in ("h0", "h1", "h2"):
        for begin in range(0, BITS, STEP):
            cell = F.shiftright(word, BITS - begin - STEP).bitwiseAND(F.lit((1 << STEP) - 1)).cast("int")
            rows = rows.withColumn("cell", cell)
            # dealt by prefix once: the windows below need no further exchange
            sums = rows.groupBy("prefix", "cell").agg(F.sum("bytes").alias("bytes")).repartition("prefix")
            depth, inside = F.lit(None).cast("int"), F.lit(None).cast("bigint")
            for d in range(STEP, -1, -1):       # smallest depth that fits wins
                at = Window.partitionBy("prefix", F.shiftright("cell", STEP - d))     # at most 2^STEP rows
                sums = sums.withColumn(f"s{d}", F.sum("bytes").over(at))
                depth = F.when(F.col(f"s{d}") <= limit, d).otherwise(depth)
                inside = F.when(F.col(f"s{d}") <= limit, F.col(f"s{d}")).otherwise(inside)
            bits = F.lpad(F.conv(F.col("cell").cast("string"), 10, 2), STEP, "0")
            last = word == "h2" and begin + STEP >= BITS
            if last:
                depth, inside = F.coalesce(depth, F.lit(STEP)), F.coalesce(inside, F.col(f"s{STEP}"))
            directory = written(sums.select(
                "prefix", "cell", depth.isNotNull().alias("fits"), inside.alias("shard_bytes"),
                F.concat("prefix", F.substring(bits, F.lit(1), F.coalesce(depth, F.lit(STEP)))).alias("shard")), "shard-directory")
            found = rows.join(directory, ["prefix", "cell"])
            part = found.where("fits").select("key", "bytes", "shard", F.length("shard").alias("depth"), "shard_bytes", *names)
            done = part if done is None else done.unionByName(part)
            if directory.where("not fits").isEmpty():
                return done
            rows = written(found.where("not fits").select("key", "bytes", "h0", "h1", "h2", *kept,
                                                          F.col("shard").alias("prefix")), "shard-rest")
    return done
