"""J3 on live request and response streams.

Same answer as :func:`gatehouse.operators.match.match_within` -- each request
with its earliest response in ``[ts, ts + limit)`` -- computed incrementally by
a state processor (``transformWithState``) with its state in RocksDB.

Time is cut into buckets as long as the limit. A request's answer lies in its
own bucket or the next, so a request belongs to the group (key, bucket) and a
response to two groups: its own bucket's and the one before. State is split by
that group, not by key: groups are hashed to ``shards`` state keys (one Python
call per shard and batch), and a hot key is spread over as many shards as it
has buckets. A key that is dense within one bucket is split further with
``split``: buckets are so many times shorter, and a response goes to ``split + 1`` of them.

A shard's events are kept as runs: at most ``RUN`` events of one kind each, in
order of time, one map entry a run, and the run's first and last time in
an index. A batch adds runs and touches no older one. A request is final once its
deadline ``ts + limit`` is behind the watermark (later rows are dropped by Spark, so no
earlier response can still arrive); a timer is set for the next such deadline. Then the runs in
reach are merged backwards in time, opened one by one: a step holds the open runs and the next response of each
group, however many events the shard has. Final requests are emitted once
in append mode and leave the state, and runs of responses older than both the watermark
and the oldest pending request go too, so state is bounded by the ``limit +
delay`` stretch of event time, not by the stream's length. Requests whose deadline
is not yet behind the watermark stay in state. A null key matches nothing. Ids are carried, never computed with.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gatehouse.operators.match import MICROS, event_micros

# The processor runs in Python workers; ship this module's code with it (by
# value) so workers need only pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MATCH_SCHEMA = "req_id {qtype}, {key} {ktype}, resp_id {rtype}, delay_us bigint"
# ids and keys travel as text: pandas would turn integers with nulls into floats
STEP_SCHEMA = "req_id string, key string, resp_id string, delay_us bigint, payload string"
STEP_COLUMNS = ["req_id", "key", "resp_id", "delay_us", "payload"]
INTEGERS = ("tinyint", "smallint", "int", "bigint")
SHARDS_PER_PARTITION = 4
RUN = 4096              # events of a run
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REQUEST, RESPONSE = 1, 0


def id_order(x: str, integer_ids: bool):
    return int(x) if integer_ids else x


def backwards(runs: list[tuple[int, int]], load) -> Iterator[tuple]:
    """The events (us, kind, id, key, bucket, payload) of runs, latest first, at one time the responses
    first. ``runs`` holds (last time, number); ``load`` gives a run's events in order of time.
    A run is opened when its last event is due."""
    waiting = sorted(runs)
    heap: list[tuple] = []

    def step(events: list, at: int) -> None:
        if at >= 0:
            e = events[at]
            heapq.heappush(heap, (-e[0], e[1], len(heap), id(events), at, events))

    while waiting or heap:
        while waiting and (not heap or waiting[-1][0] >= -heap[0][0]):
            events = load(waiting.pop()[1])
            step(events, len(events) - 1)
        _, _, _, _, at, events = heapq.heappop(heap)
        yield events[at]
        step(events, at - 1)


def matches(events: Iterator[tuple], limit_us: int, before_us: int, integer_ids: bool) -> Iterator[tuple]:
    """(req_id, key, resp_id, delay_us, payload) of the requests before ``before_us``, from events latest first;
    of responses at one time the lowest id counts."""
    upcoming: dict[tuple, tuple] = {}
    for us, kind, i, key, b, payload in events:
        if kind == RESPONSE:
            if key is not None:
                held = upcoming.get((key, b))
                if held is None or held[0] > us or id_order(i, integer_ids) < id_order(held[1], integer_ids):
                    upcoming[key, b] = (us, i, payload)
        elif us < before_us:
            held = upcoming.get((key, b)) if key is not None else None
            if held is not None and held[0] - us < limit_us:
                yield i, key, held[1], held[0] - us, held[2]
            else:
                yield i, key, None, None, None


class Matcher(StatefulProcessor):
    """The state of one shard: runs of events in order of time, and their index."""

    def __init__(self, limit_us: int, integer_ids: bool, run: int):
        self.limit_us, self.integer_ids, self.run = limit_us, integer_ids, run

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getMapState("runs", "run bigint", "us array<bigint>, id array<string>, key array<string>, b array<bigint>, payload array<string>")
        self.index = handle.getMapState("index", "run bigint", "kind int, first bigint, last bigint")
        self.number = handle.getValueState("number", "n bigint")

    def _put(self, run: int, kind: int, events: list[tuple]) -> None:
        us, *rest = (list(x) for x in zip(*events))
        self.runs.updateValue((run,), (us, *rest))
        self.index.updateValue((run,), (kind, us[0], us[-1]))

    def _load(self, run: int, kind: int) -> list[tuple]:
        return [(us, kind, *rest) for us, *rest in zip(*self.runs.getValue((run,)))]

    def _drop(self, run: int) -> None:
        self.runs.removeKey((run,))
        self.index.removeKey((run,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = self.number.get()[0] if self.number.exists() else 0
        earliest = None
        for pdf in rows:
            part = pdf.sort_values("us", kind="stable")
            for kind, some in part.groupby("kind"):
                texts = ([x if isinstance(x, str) else None for x in some[c]] for c in ("id", "key", "payload"))
                ids, keys, payloads = texts
                events = list(zip(some["us"].tolist(), ids, keys, some["b"].tolist(), payloads))
                for at in range(0, len(events), self.run):
                    self._put(n, int(kind), events[at:at + self.run])
                    n += 1
                due = events[0][0] + self.limit_us if kind == REQUEST else events[-1][0]
                earliest = due if earliest is None else min(earliest, due)
        self.number.update((n,))
        held = min(self.handle.listTimers(), default=None)
        if earliest is not None and (held is None or earliest // 1000 < held):
            self._wake(earliest, timerValues)
        return iter(())

    def _wake(self, due_us: int, timers) -> None:
        """One timer: the next deadline, or the time when the last response can go."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(max(due_us // 1000, timers.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        before = wm_us - self.limit_us                      # requests before it are final
        index = {r[0]: tuple(v) for r, v in self.index.iterator()}
        asked = [r for r, (kind, first, _) in index.items() if kind == REQUEST and first < before]
        if asked:
            since = min(index[r][1] for r in asked)
            reach = asked + [r for r, (kind, first, last) in index.items() if kind == RESPONSE and last >= since and first < wm_us]
            out = []
            events = backwards([(index[r][2], r) for r in reach], lambda r: self._load(r, index[r][0]))
            for found in matches(events, self.limit_us, before, self.integer_ids):
                out.append(found)
                if len(out) == 10_000:
                    yield pd.DataFrame(out, columns=STEP_COLUMNS).astype({"delay_us": "Int64"})
                    out = []
            if out:
                yield pd.DataFrame(out, columns=STEP_COLUMNS).astype({"delay_us": "Int64"})
        for r in asked:                                     # what is not final yet stays
            rest = [] if index[r][2] < before else [(us, *e) for us, _, *e in self._load(r, REQUEST) if us >= before]
            if rest:
                self._put(r, REQUEST, rest)
                index[r] = (REQUEST, rest[0][0], rest[-1][0])
            else:
                self._drop(r)
                del index[r]
        pending = min((first for kind, first, _ in index.values() if kind == REQUEST), default=None)
        floor = wm_us if pending is None else min(wm_us, pending)
        for r in [r for r, (kind, _, last) in index.items() if kind == RESPONSE and last < floor]:
            self._drop(r)
            del index[r]
        if index:
            self._wake(pending + self.limit_us if pending is not None else max(last for _, _, last in index.values()), timerValues)
        else:
            self.number.clear()

    def close(self) -> None:
        pass


def match_within_stream(requests: DataFrame, responses: DataFrame, key: str, seconds: float,
                        delay: str = "10 minutes", ts: str = "ts", id_col: str = "event_id",
                        shards: int | None = None, split: int = 1, payload: Column | None = None) -> DataFrame:
    """Streaming (req_id, <key>, resp_id, delay_us); one row per request.

    With ``payload``, a text column expression over ``responses``, also ``payload``: that of the answer.

    ``requests`` and ``responses`` are streaming frames with ``id_col`` and ``key``
    (of types that text keeps unchanged); rows without a time match nothing and
    are left out. ``ts`` (``timestamp`` or ``timestamp_ntz``, read as UTC).
    ``delay`` is the watermark delay: how late a row may arrive and count.

    ``shards``: number of state keys, by default four per shuffle partition (a setting sized to
    the cluster and data). ``split``: buckets in a limit, for keys that are dense within one.
    Neither changes the result, and both must stay the same over a checkpoint.

    State processors need the RocksDB state store, which is set for the session here.
    """
    spark = requests.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    limit_us = int(round(seconds * MICROS))
    width = max(1, -(-limit_us // split))
    if shards is None:
        shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")) * SHARDS_PER_PARTITION)

    def side(df: DataFrame, kind: int) -> DataFrame:
        held = payload if payload is not None and kind == RESPONSE else F.lit(None)
        return df.select(held.cast("string").alias("payload"), F.col(key).cast("string").alias("key"), F.col(id_col).cast("string").alias("id"),
                         F.col(ts).cast("timestamp").alias("ts"), F.lit(kind).alias("kind")).where("ts is not null")

    events = side(requests, REQUEST).unionByName(side(responses, RESPONSE)).withWatermark("ts", delay)
    us = event_micros("ts")
    own = ((us - F.pmod(us, F.lit(width))) / width).cast("bigint")
    buckets = F.when(F.col("kind") == REQUEST, F.array(own)).otherwise(F.array(*(own - k for k in range(split + 1))))
    routed = (events.select("key", "id", "payload", "ts", "kind", us.alias("us"), F.explode(buckets).alias("b"))
              .withColumn("shard", F.pmod(F.xxhash64("key", "b"), F.lit(shards))))
    types = {"ktype": requests.schema[key].dataType.simpleString(),
             "qtype": requests.schema[id_col].dataType.simpleString(),
             "rtype": responses.schema[id_col].dataType.simpleString()}
    found = routed.groupBy("shard").transformWithStateInPandas(
        Matcher(limit_us, types["rtype"] in INTEGERS, RUN), STEP_SCHEMA, "Append", "EventTime")
    return found.select(F.col("req_id").cast(types["qtype"]).alias("req_id"), F.col("key").cast(types["ktype"]).alias(key),
                        F.col("resp_id").cast(types["rtype"]).alias("resp_id"), "delay_us", *(["payload"] if payload is not None else []))
