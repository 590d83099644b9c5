"""Mixing sources to target weights by entropy balancing. DataFrame functions only.

Each source has a token target. Document rates w minimise the relative entropy
sum(w log w - w) under sum(w * size) = target and w <= 2; the solution is an
exponential tilt w = min(2, exp(lambda * size / mean size)) with one multiplier
for each source, the root of a monotone function. Newton iterations on that dual are
Spark aggregates over a (source, size) count table, kept inside a bracket so
that a step can never leave it. Sources whose target is the bound have w = 2.

Rates become copies: floor(w), and one more for the documents that come first
in a fixed pseudo-random order of (u - fractional part), as far as they fit in the
source's remaining words; one that does not fit is skipped. Documents with copies
to spare then get one more in the same way, until none fits. Last, the copies of
each source's ``CHANGE`` smallest documents are chosen anew, out of all choices
the one whose words come nearest to the target from below: a source of so few
documents ends at the best sum there is, and a larger one closer than its smallest document.

No source is ordered or summed in one task: the place in the order has
``LEVELS * DIGIT`` bits, and the threshold is found digit by digit, each time on
at most ``2 ** DIGIT`` partial sums of a source. Only documents that share all
bits with the threshold are put in exact order. A document that does not fit is
larger than the words left, so the search is repeated over the documents that still
fit; a source's last ``FEW`` are gone through one by one.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatehouse.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5             # words of the mix against words of the table
MOST = 2.0              # most copies of a document, and of a source
DIGIT = 7
LEVELS = 3
FEW = 1 << DIGIT        # documents of a source that one task goes through
CHANGE = 12             # documents of a source whose copies are chosen by their exact sum
TOLERANCE = 1e-9
MAX_STEPS = 60


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from ``sizes`` (source, source_size).

    Weights 5, 2, 1 repeat over the sources by code point, null last. Targets
    share ``share`` of all words by weight; one that would exceed ``most``
    times its source's words stops there, and its excess is shared again.
    The order of the sources is a range partitioning, so their number is
    not bounded by one task.
    """
    ranged = written(sizes.repartitionByRange(F.col("source").asc_nulls_last())
                     .withColumn("pid", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)   # a row for each partition
    offset = ranged.groupBy("pid").count().select("pid", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("off"))
    nth = F.row_number().over(Window.partitionBy("pid").orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.col("nth") % len(WEIGHTS) + 1).cast("int"))
    src = written(ranged.withColumn("nth", nth).join(offset, "pid").withColumn("nth", F.col("nth") + F.col("off"))
                  .select("source", "source_size", weight.alias("weight"),
                          (F.col("source_size") * most).alias("bound")), "mix-weights")
    first = src.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * (first[0] or 0)
    per_weight, capped = (total / first[1] if first[1] else 0.0), -1
    while True:
        over = F.col("bound") <= F.col("weight") * per_weight
        got = src.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("bound"))),
                      F.sum(F.when(~over, F.col("weight")))).first()
        if got[0] == capped or not got[2]:
            break
        capped = got[0]
        per_weight = (total - (got[1] or 0.0)) / got[2]
    return src.select("source", "source_size", F.least("bound", F.col("weight") * per_weight).alias("target"))


def tilts(counts: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """(source, source_size, target, mean, lam, full): the multiplier of each source.

    ``counts`` (source, size, n) holds how many documents have each size.
    ``full``: the target is the bound, so every document has the rate ``most``.
    """
    known = counts.where("size > 0")
    seen = known.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"),
                                       F.min("size").alias("least"))
    full = F.col("target") >= F.col("source_size") * most * (1 - 1e-12)
    state = written(
        targets.join(seen, targets["source"].eqNullSafe(seen["source"])).select(
            targets["source"], "source_size", "target", "mean", full.alias("full"), full.alias("done"),
            F.lit(-1e9).alias("lo"),                                    # all rates vanish
            (F.col("mean") / F.col("least") * math.log(most)).alias("hi"),  # all rates are `most`
            F.lit(0.0).alias("lam")), "mix-dual")
    for _ in range(MAX_STEPS):
        if state.where("not done").isEmpty():
            break
        z = F.col("size") / F.col("mean")
        rate = F.least(F.lit(most), F.exp(F.col("lam") * z))
        mass = F.col("n") * F.col("size") * rate
        cell = known.join(state.where("not done"), known["source"].eqNullSafe(state["source"]))
        sums = (cell.groupBy(state["source"].alias("s"))
                .agg(F.sum(mass).alias("got"), F.sum(F.when(rate < most, mass * z)).alias("slope")))
        both = state.join(sums, state["source"].eqNullSafe(sums["s"]), "left").drop("s")
        miss = F.col("got") - F.col("target")
        near = F.abs(miss) <= F.greatest(F.lit(0.01), F.col("target") * TOLERANCE)
        both = both.withColumns({
            "lo": F.when(miss < 0, F.col("lam")).otherwise(F.col("lo")),
            "hi": F.when(miss > 0, F.col("lam")).otherwise(F.col("hi")),
            "newton": F.col("lam") - miss / F.col("slope")})
        inside = (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi"))
        step = F.when(inside, F.col("newton")).otherwise((F.col("lo") + F.col("hi")) / 2)
        state = written(both.select("source", "source_size", "target", "mean", "full",
                                    (F.col("done") | F.coalesce(near, F.lit(True))).alias("done"), "lo", "hi",
                                    F.when(F.col("done") | near, F.col("lam")).otherwise(step).alias("lam")), "mix-dual")
    return state.select("source", "source_size", "target", "mean", "lam", "full")


def prefix_taken(free: DataFrame, room: DataFrame) -> DataFrame:
    """``free`` with ``taken``: the documents of each source that come first in order and fit together."""
    # `below`: slots under it are taken; `prefix`: the digits of the threshold so far
    cut = room.select("s", "left", F.lit(0).cast("bigint").alias("below"), F.lit(0).cast("bigint").alias("prefix"))
    for shift in range(DIGIT * (LEVELS - 1), -1, -DIGIT):
        inside = free.join(cut, F.col("source").eqNullSafe(F.col("s"))
                           & (F.shiftright("slot", shift + DIGIT) == F.col("prefix")))
        part = inside.groupBy("s", "left", F.shiftright("slot", shift).alias("digit")).agg(F.sum("size").alias("more"))
        upto = Window.partitionBy("s").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)   # at most 2^DIGIT rows
        part = part.withColumn("cum", F.sum("more").over(upto))
        fits = F.col("cum") <= F.col("left")
        found = part.groupBy(F.col("s").alias("s2")).agg(F.min(F.when(~fits, F.col("digit"))).alias("split"),
                                                         F.max(F.when(fits, F.col("cum"))).alias("used"))
        joined = cut.join(found, F.col("s").eqNullSafe(F.col("s2")), "left")
        beyond = F.shiftleft(F.col("prefix") + 1, shift + DIGIT)        # all of this digit's slots fit
        cut = written(joined.select(
            "s", (F.col("left") - F.coalesce("used", F.lit(0))).alias("left"),
            F.when(F.col("prefix") < 0, F.col("below")).when(F.col("split").isNotNull(), F.shiftleft("split", shift))
            .otherwise(beyond).alias("below"),
            F.coalesce("split", F.lit(-1).cast("bigint")).alias("prefix")), "mix-cut")
    at_split = free.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("slot") == F.col("prefix"))).drop("s")
    run = F.sum("size").over(Window.partitionBy("source").orderBy("place", "doc_id", "size", "rid")
                             .rowsBetween(Window.unboundedPreceding, 0))
    added = written(at_split.withColumn("run", run).where("run <= left").select("rid", F.lit(True).alias("plus")), "mix-split")
    placed = free.join(cut.select("s", "below"), F.col("source").eqNullSafe(F.col("s"))).drop("s").join(added, "rid", "left")
    return placed.select(*free.columns, ((F.col("slot") < F.col("below")) | F.coalesce("plus", F.lit(False))).alias("taken"))


def few_taken(free: DataFrame, room: DataFrame) -> DataFrame:
    """(rid, source, size) of the documents that fit when each source's are gone through in order."""
    each = (free.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("place", "doc_id", "size", "rid"))).alias("all"))
            .join(room, F.col("source").eqNullSafe(F.col("s"))))
    none = F.filter("all", lambda d: F.lit(False))
    got = F.aggregate("all", F.struct(F.col("left").alias("left"), none.alias("got")), lambda acc, d: F.when(
        d["size"] <= acc["left"], F.struct((acc["left"] - d["size"]).alias("left"),
                                           F.concat(acc["got"], F.array(d)).alias("got"))).otherwise(acc))
    return each.select("source", F.explode(got["got"]).alias("d")).select("d.rid", "source", "d.size")


def fill(free: DataFrame, room: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Frames of the ``rid`` taken, and ``room`` (s, left) afterwards.

    The documents of ``free`` (rid, doc_id, source, size, place, slot) are gone
    through in order of their place; each that fits in the words left is taken.
    One that does not fit now will not fit later, so each round begins with
    those that fit, and takes the first of them at least.
    """
    picks = []
    while True:
        fits = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") <= F.col("left"))
        free = written(free.join(room, fits).drop("s", "left"), "mix-free")
        most_rows = free.groupBy("source").count().agg(F.max("count")).first()[0]
        if not most_rows:
            return picks, room
        if most_rows <= FEW:
            got = written(few_taken(free, room), "mix-few")
        else:
            marked = written(prefix_taken(free, room), "mix-marked")
            got = marked.where("taken")
        picks.append(got.select("rid"))
        spent = got.groupBy(F.col("source").alias("s2")).agg(F.sum("size").alias("spent"))
        room = written(room.join(spent, F.col("s").eqNullSafe(F.col("s2")), "left")
                       .select("s", (F.col("left") - F.coalesce("spent", F.lit(0))).alias("left")), "mix-room")
        if most_rows <= FEW:
            return picks, room
        free = marked.where("not taken").drop("taken")


def settled(placed: DataFrame, room: DataFrame, most: int) -> DataFrame:
    """(rid, copies) of each source's ``CHANGE`` smallest documents: of all choices of 0 to ``most``
    copies the largest sum within their present words and the words left, of those the least change.

    ``placed`` has (rid, source, size, place, copies), ``room`` (s, left). The sums of two halves
    of the documents meet in one order: each of the one finds the largest of the other that fits.
    """
    half = max(1, int(CHANGE // 2 * math.log(3) / math.log(most + 1)))         # (most + 1) ** half sums at most
    order = Window.partitionBy("source").orderBy("size", "place", "rid")
    few = placed.where("size > 0").select("source", "size", "place", "rid", "copies").withColumn("n", F.row_number().over(order)).where(F.col("n") <= 2 * half)
    each = few.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("n", "size", "rid", "copies"))).alias("all"))
    each = written(each.join(room, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "all", (F.col("left") + F.aggregate("all", F.lit(0).cast("bigint"), lambda a, d: a + d["copies"] * d["size"])
                          + 1e-7).alias("most")), "mix-change")

    def ways(part: Column) -> Column:
        start = F.array(F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).cast("bigint").alias("kept"), F.array().cast("array<int>").alias("times")))
        return F.aggregate(part, start, lambda sums, d: F.flatten(F.transform(sums, lambda w: F.transform(
            F.sequence(F.lit(0), F.lit(most)), lambda x: F.struct(
                (w["sum"] + x * d["size"]).alias("sum"), (w["kept"] - F.abs(x - d["copies"])).alias("kept"),
                F.concat(w["times"], F.array(x)).alias("times"))))))

    one = each.select("source", "most", F.inline(ways(F.slice("all", 1, half)))).withColumn("key", F.col("most") - F.col("sum"))
    two = each.select("source", F.lit(None).cast("double").alias("most"), F.inline(ways(F.slice("all", half + 1, half)))).withColumn("key", F.col("sum").cast("double"))
    way = F.struct("sum", "kept", "times")
    upto = Window.partitionBy("source").orderBy("key", "first").rowsBetween(Window.unboundedPreceding, 0)
    met = (one.withColumn("first", F.lit(True)).unionByName(two.withColumn("first", F.lit(False)))
           .withColumn("other", F.max(F.when(~F.col("first"), way)).over(upto)).where(F.col("first") & F.col("other").isNotNull()))
    best = met.groupBy(F.col("source").alias("s")).agg(F.max(F.struct(
        (F.col("sum") + F.col("other.sum")).alias("sum"), (F.col("kept") + F.col("other.kept")).alias("kept"),
        F.concat("times", "other.times").alias("times"))).alias("best"))
    chosen = each.join(best, F.col("source").eqNullSafe(F.col("s"))).select(
        F.explode(F.arrays_zip(F.col("all"), F.col("best.times").alias("times"))).alias("d"))
    return chosen.select(F.col("d.all.rid").alias("rid"), F.col("d.times").cast("bigint").alias("copies"))


def mix_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             carry: dict[str, Column] | None = None, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) and ``carry`` for every row of ``docs``.

    Null texts have size 0; null sources form one source, the last in order.
    Rows of size 0 are taken 0 times. Rows that agree in id and size are told
    apart by a row number, so repeated rows may get different copies; which of
    them gets more makes no difference. An empty table gives an empty result.
    Reruns over the same rows give the same copies: the order of rounding
    depends on the ids only.
    """
    extra = [c.alias(f"c_{n}") for n, c in (carry or {}).items()]
    names = [F.col(f"c_{n}").alias(n) for n in (carry or {})]
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                       word_count(F.col(text).cast("string")).alias("size"), *extra)
    rows = written(base.withColumn("rid", F.monotonically_increasing_id()), "mix-rows")
    counts = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = written(source_targets(sizes, share, most), "mix-targets")
    state = tilts(counts, targets, most).drop("source_size", "target").withColumnRenamed("source", "s")
    plan = written(targets.join(state, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix-plan")

    # rates, whole copies and the place in the order of rounding
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("full"), most).otherwise(
        F.least(F.lit(most), F.exp(F.col("lam") * F.col("size") / F.col("mean"))))
    def u(name: str) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.lit(name), "doc_id"), 11) / float(1 << 53)

    rated = rows.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rated = rated.withColumn("rate", rate).withColumn("whole", F.floor("rate"))
    rated = rated.withColumn("place", u("mix") - (F.col("rate") - F.col("whole")))
    rated = rated.withColumn("open", (F.col("size") > 0) & (F.col("rate") > F.col("whole")))
    def slot(place: str) -> Column:
        return F.floor((F.col(place) + 1) * ((1 << (DIGIT * LEVELS)) / 2))

    rated = written(rated.select("rid", "doc_id", "source", "size", "source_size", "target", "whole", "place", "open",
                                 *(f"c_{n}" for n in (carry or {}))), "mix-rated")
    room = written(rated.groupBy("source").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("left"))
                   .withColumnRenamed("source", "s"), "mix-room")
    narrow = ["rid", "doc_id", "source", "size", "place"]
    picks, room = fill(rated.where("open").select(*narrow).withColumn("slot", slot("place")), room)
    def given() -> DataFrame:
        if not picks:
            return rated.withColumn("copies", F.col("whole"))
        times = written(reduce(DataFrame.unionByName, picks).groupBy("rid").agg(F.count("*").alias("plus")), "mix-picks")
        return rated.join(times, "rid", "left").withColumn("copies", F.col("whole") + F.coalesce("plus", F.lit(0)))

    for level in range(int(most)):      # one more copy of the documents that may have it and fit
        spare = given().where((F.col("copies") <= most - 1) & (F.col("size") > 0)).withColumn("place", u(f"more {level + 1}"))
        more, room = fill(spare.select(*narrow).withColumn("slot", slot("place")), room)
        if not more:
            break
        picks = picks + more
    placed = written(given().withColumn("copies", F.col("copies").cast("bigint")), "mix-placed")
    change = settled(placed, room, int(most)).select(F.col("rid").alias("r"), F.col("copies").alias("better"))
    placed = placed.join(change, F.col("rid") == F.col("r"), "left").withColumn("copies", F.coalesce("better", "copies"))
    return placed.select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "copies",
        (F.col("copies") * F.col("size")).alias("taken"), *names)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs``, same columns (of any names), every row as often as the mix takes it (0, 1 or 2 times).

    Null and empty texts have no words and are taken 0 times; null sources form one source. Wholly equal rows
    are counted before they are dealt out, and their copies come out of one of them. An
    empty table gives an empty result.
    """
    cols = [F.col(f"`{c}`") for c in sorted(docs.columns)]
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         F.xxhash64(*cols).alias("d1"), F.xxhash64(F.lit("second"), *reversed(cols)).alias("d2"))
    read = packed.select("d1", "d2", *(F.col("row").getField(c).alias(n) for c, n in ((doc_id, "doc_id"), (text, "text"), (source, "source"))))
    plan = mix_plan(read, carry={"d1": F.col("d1"), "d2": F.col("d2")})
    times = plan.groupBy("d1", "d2").agg(F.sum("copies").cast("int").alias("times")).where("times > 0")
    taken = packed.dropDuplicates(["d1", "d2"]).join(times, ["d1", "d2"])
    return (taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
            .select(*(F.col("row").getField(c).alias(c) for c in docs.columns)))
