"""Match each request with its earliest response within a time limit.

An as-of (forward) join per key that emits no pairs and needs no assumption
about how the rows concentrate on a key or in time:

1. Requests and responses are range-partitioned on the total order (key, time,
   kind, id). Spark samples these keys, so a hot key is cut into as many
   partitions as its rows need. The dealt rows are written once to the shared
   folder: both steps below must see the same cuts.
2. Inside a (partition, key) group, one running window in descending order
   carries the last response seen: each request's next response.
3. A request that has none there takes the first response of the same key in
   the next partition that has one. Only a key at the edge of a partition can
   go on in another, so that table has at most two keys for each partition
   and is broadcast.

The window is half-open: ``req.ts <= resp.ts < req.ts + limit``. Ties on time go
to the lowest response id. Every request is kept; unmatched ones get nulls.
A null key or time matches nothing. Ids are carried, never computed with, so
they may be of any type that can be ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatehouse.session import shared_table

MICROS = 1_000_000


def event_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch; ``timestamp_ntz`` is read as UTC."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def match_within(requests: DataFrame, responses: DataFrame, key: str, seconds: float,
                 ts: str = "ts", id_col: str = "event_id", partitions: int | None = None) -> DataFrame:
    """(req_id, <key>, resp_id, delay_us) for every request.

    ``requests`` and ``responses`` carry ``id_col``, ``key`` and ``ts``;
    ``partitions`` (default: the session's shuffle partitions) only sets how
    finely the order is cut.
    """
    spark = requests.sparkSession
    limit_us = int(round(seconds * MICROS))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

    def side(df: DataFrame, kind: int) -> DataFrame:
        return df.select(F.col(key).alias("k"), event_micros(ts).alias("t"), F.lit(kind).alias("kind"),
                         F.col(id_col).alias("id"))

    usable = F.col("k").isNotNull() & F.col("t").isNotNull()
    req = side(requests, 0)
    dealt = shared_table(
        req.where(usable).unionByName(side(responses, 1).where(usable))
        .repartitionByRange(n, "k", "t", "kind", "id").withColumn("pid", F.spark_partition_id()), "j3-dealt")

    response = F.when(F.col("kind") == 1, F.struct("t", "id"))
    # descending: a response of the same time comes before the request, and of
    # several the one with the lowest id comes last
    seen = (Window.partitionBy("pid", "k").orderBy(F.col("t").desc(), F.col("kind").desc(), F.col("id").desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = dealt.withColumn("next", F.last(response, ignorenulls=True).over(seen)).where("kind = 0")

    edges = dealt.groupBy("pid").agg(F.min("k").alias("low"), F.max("k").alias("high"))
    edge_keys = edges.select(F.explode(F.array("low", "high")).alias("k")).distinct()
    firsts = dealt.join(F.broadcast(edge_keys), "k").groupBy("k", "pid").agg(F.min(response).alias("first"))
    later = Window.partitionBy("k").orderBy(F.col("pid").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ahead = firsts.select("k", "pid", F.last("first", ignorenulls=True).over(later).alias("ahead"))
    answered = (inside.join(F.broadcast(ahead), ["k", "pid"], "left")     # at most two keys a partition
                .select("id", "k", "t", F.coalesce("next", "ahead").alias("hit")))

    delay = F.col("hit.t") - F.col("t")
    within = delay < F.lit(limit_us)
    out = answered.select(F.col("id").alias("req_id"), F.col("k").alias(key),
                          F.when(within, F.col("hit.id")).alias("resp_id"),
                          F.when(within, delay).cast("bigint").alias("delay_us"))
    resp_type = responses.schema[id_col].dataType
    lost = req.where(~usable).select(F.col("id").alias("req_id"), F.col("k").alias(key),
                                     F.lit(None).cast(resp_type).alias("resp_id"),
                                     F.lit(None).cast("bigint").alias("delay_us"))
    return out.unionByName(lost)
