"""J3 against a brute-force search; T1 over several batches with late rows."""

import datetime as dt
import os
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from gatehouse.operators import match_within

T0 = dt.datetime(2024, 1, 1)


def brute(reqs, resps, limit_us):
    out = {}
    for rid, key, t in reqs:
        best = None
        for sid, k2, t2 in resps:
            d = (t2 - t) // dt.timedelta(microseconds=1)
            if k2 == key and 0 <= d < limit_us and (best is None or (d, sid) < best):
                best = (d, sid)
        out[rid] = (key, best[1] if best else None, best[0] if best else None)
    return out


def run(spark, reqs, resps, seconds, partitions=None):
    schema = "event_id bigint, user_id bigint, ts timestamp_ntz"
    q = spark.createDataFrame(reqs, schema)
    r = spark.createDataFrame(resps, schema)
    res = match_within(q, r, "user_id", seconds, partitions=partitions)
    return {x.req_id: (x.user_id, x.resp_id, x.delay_us) for x in res.collect()}


def test_edges(spark):
    s = dt.timedelta(seconds=1)
    reqs = [(1, 7, T0), (2, 7, T0 + 10 * s), (3, 8, T0)]
    resps = [(10, 7, T0), (11, 7, T0 + 10 * s + 300 * s), (12, 7, T0 + 10 * s + 299 * s),
             (13, 7, T0 + 10 * s + 299 * s), (14, 8, T0 - s)]
    got = run(spark, reqs, resps, 300)
    # same time matches (delay 0); exactly the limit does not; ties -> lowest id
    assert got == {1: (7, 10, 0), 2: (7, 12, 299_000_000), 3: (8, None, None)}
    assert got == brute(reqs, resps, 300_000_000)


@settings(max_examples=12, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([60, 300, 3600]), st.sampled_from([None, 1, 23]))
def test_random_vs_brute_force(spark, seed, seconds, parts):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 3), T0 + dt.timedelta(microseconds=rnd.randint(0, 4 * seconds * 10**6)))
            for i in range(60)]
    reqs = [r for r in rows if r[0] % 2 == 0]
    resps = [r for r in rows if r[0] % 2 == 1] + [(1000 + i, r[1], r[2]) for i, r in enumerate(reqs[:5])]
    assert run(spark, reqs, resps, seconds, parts) == brute(reqs, resps, seconds * 10**6)


def test_hot_key_is_cut_into_many_partitions(spark):
    rnd = random.Random(3)
    rows = [(i, 1, T0 + dt.timedelta(seconds=rnd.randint(0, 20_000))) for i in range(400)]
    reqs, resps = rows[::2], rows[1::2]
    assert run(spark, reqs, resps, 300, 16) == brute(reqs, resps, 300 * 10**6)
    schema = "event_id bigint, user_id bigint, ts timestamp_ntz"
    out = match_within(spark.createDataFrame(reqs, schema), spark.createDataFrame(resps, schema), "user_id", 300, partitions=16)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "pid" in plan                     # groups are (partition, key), never the key alone


BIG = 2**53 + 1


def test_ids_beyond_doubles_null_keys_and_keys_without_responses(spark):
    s = dt.timedelta(seconds=1)
    reqs = [(BIG, 1, T0), (BIG + 2, None, T0), (3, 5, T0), (4, 1, None), (None, 1, T0 + 400 * s)]
    resps = [(BIG + 4, 1, T0 + s), (BIG + 6, None, T0 + s), (9, 6, T0), (10, 1, None)]
    got = run(spark, reqs, resps, 300, 5)
    assert got == {BIG: (1, BIG + 4, 1_000_000), BIG + 2: (None, None, None), 3: (5, None, None), 4: (1, None, None),
                   None: (1, None, None)}


def test_string_ids(spark):
    schema = "event_id string, user_id bigint, ts timestamp_ntz"
    s = dt.timedelta(seconds=1)
    q = spark.createDataFrame([("q1", 1, T0), ("q2", 2, T0)], schema)
    r = spark.createDataFrame([("r9", 1, T0 + s), ("r10", 1, T0 + s)], schema)
    got = {tuple(x) for x in match_within(q, r, "user_id", 300).collect()}
    assert got == {("q1", 1, "r10", 1_000_000), ("q2", 2, None, None)}


def test_empty_sides(spark):
    one = [(1, 1, T0)]
    assert run(spark, [], one, 300) == {} and run(spark, one, [], 300) == {1: (1, None, None)}


def test_stream_batches_and_late_rows(spark, tmp_dir):
    import pandas as pd
    from pyspark.sql import functions as F

    from gatehouse.streaming import match_within_stream

    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    os.makedirs(src)
    m = dt.timedelta(minutes=1)

    def drop(name, rows):
        pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "event_type"]).to_parquet(
            os.path.join(src, name), coerce_timestamps="us", allow_truncated_timestamps=True)

    schema = "event_id bigint, user_id bigint, ts timestamp, event_type string"
    ev = spark.readStream.schema(schema).parquet(src)
    q = ev.where(F.col("event_type") == "click").drop("event_type")
    r = ev.where(F.col("event_type") == "view").drop("event_type")
    out = match_within_stream(q, r, "user_id", 300, delay="2 minutes", shards=4)
    run_ = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
            .outputMode("append").trigger(availableNow=True))

    b1 = [(1, 1, T0, "click"), (2, 1, T0 + 2 * m, "view"), (3, 2, T0 + m, "click"),
          (4, 3, T0 + 3 * m, "click")]
    b2 = [(5, 2, T0 + 30 * m, "view"), (6, 3, T0 + 4 * m, "view"), (7, 1, T0 + 40 * m, "click")]
    b3 = [(8, 1, T0 + m, "view"),                # later than the watermark: dropped
          (9, 9, T0 + 90 * m, "click")]          # moves the watermark on
    for i, batch in enumerate([b1, b2, b3]):
        drop(f"b{i}.parquet", batch)
        run_.start().awaitTermination()
    got = {x.req_id: (x.resp_id, x.delay_us) for x in spark.read.parquet(sink).collect()}
    # 1 -> 2 (2 min); 3 unanswered (view 5 is 29 min later); 4 -> 6 (1 min);
    # 7 final once the watermark passed 40 + 5 min; 9 still waiting in state
    assert got == {1: (2, 120_000_000), 3: (None, None), 4: (6, 60_000_000), 7: (None, None)}


def test_stream_request_after_its_response(spark, tmp_dir):
    import pandas as pd
    from pyspark.sql import functions as F

    from gatehouse.streaming import match_within_stream

    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    os.makedirs(src)
    m = dt.timedelta(minutes=1)
    schema = "event_id bigint, user_id bigint, ts timestamp, event_type string"
    ev = spark.readStream.schema(schema).parquet(src)
    out = match_within_stream(ev.where(F.col("event_type") == "click").drop("event_type"),
                              ev.where(F.col("event_type") == "view").drop("event_type"),
                              "user_id", 300, delay="10 minutes", shards=3)
    run_ = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
            .outputMode("append").trigger(availableNow=True))
    batches = [
        [(1, 5, T0 + 2 * m, "view"), (2, 9, T0 + 5 * m, "click")],
        [(3, 5, T0 + 1 * m, "click")],               # arrives after its answer, within the delay
        [(4, 7, T0 + 60 * m, "click")],              # moves the watermark past both deadlines
    ]
    for i, rows in enumerate(batches):
        pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "event_type"]).to_parquet(
            os.path.join(src, f"b{i}.parquet"), coerce_timestamps="us", allow_truncated_timestamps=True)
        run_.start().awaitTermination()
    got = {x.req_id: (x.resp_id, x.delay_us) for x in spark.read.parquet(sink).collect()}
    assert got == {3: (1, 60_000_000), 2: (None, None)}


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([60, 300, 3600]))
def test_a_hot_key_dense_in_one_stretch(spark, seed, seconds):
    rnd = random.Random(seed)
    span = 6 * seconds * 10**6
    rows = []
    for i in range(120):
        key = 1 if i < 60 else rnd.randint(2, 5)           # key 1 holds half of all rows
        t = rnd.randint(0, span)
        if key == 1 and rnd.random() < 0.5:
            t = rnd.randint(0, span // 20)
        rows.append((i, key, T0 + dt.timedelta(microseconds=t)))
    reqs = [r for r in rows if rnd.random() < 0.7]
    ids = {r[0] for r in reqs}
    resps = [r for r in rows if r[0] not in ids]
    assert run(spark, reqs, resps, seconds, 7) == brute(reqs, resps, seconds * 10**6)


def test_key_passing_through_partitions(spark):
    s = dt.timedelta(seconds=1)
    # key 1: 200 requests, its only response comes last; key 2 follows
    reqs = [(i, 1, T0 + i * s) for i in range(200)] + [(500, 2, T0)]
    resps = [(900, 1, T0 + 250 * s), (901, 2, T0 + 5 * s)]
    got = run(spark, reqs, resps, 300, 9)
    assert got == brute(reqs, resps, 300 * 10**6)


def test_string_keys(spark, tmp_dir):
    rnd = random.Random(11)
    rows = [(i, f"user-{rnd.randint(0, 4)}", T0 + dt.timedelta(seconds=rnd.randint(0, 3000))) for i in range(80)]
    reqs, resps = rows[::2], rows[1::2]
    schema = "event_id bigint, user_id string, ts timestamp_ntz"
    q, r = spark.createDataFrame(reqs, schema), spark.createDataFrame(resps, schema)
    want = brute(reqs, resps, 300 * 10**6)
    for res in (match_within(q, r, "user_id", 300), match_within(q, r, "user_id", 300, partitions=5)):
        assert {x.req_id: (x.user_id, x.resp_id, x.delay_us) for x in res.collect()} == want


def test_stream_string_keys(spark, tmp_dir):
    import pandas as pd
    from pyspark.sql import functions as F

    from gatehouse.streaming import match_within_stream

    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    os.makedirs(src)
    m = dt.timedelta(minutes=1)
    rows = [(1, "ann", T0, "click"), (2, "ann", T0 + 2 * m, "view"), (3, "bob", T0 + m, "click"),
            (4, "cyd", T0 + 90 * m, "click")]
    pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "event_type"]).to_parquet(
        os.path.join(src, "b0.parquet"), coerce_timestamps="us", allow_truncated_timestamps=True)
    ev = spark.readStream.schema("event_id bigint, user_id string, ts timestamp, event_type string").parquet(src)
    out = match_within_stream(ev.where(F.col("event_type") == "click").drop("event_type"),
                              ev.where(F.col("event_type") == "view").drop("event_type"),
                              "user_id", 300, delay="2 minutes", shards=2)
    (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    got = {x.req_id: (x.user_id, x.resp_id, x.delay_us) for x in spark.read.parquet(sink).collect()}
    assert got == {1: ("ann", 2, 120_000_000), 3: ("bob", None, None)}


def test_stream_drops_rows_behind_the_watermark(spark, tmp_dir):
    import pandas as pd
    from pyspark.sql import functions as F

    from gatehouse.streaming import match_within_stream

    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    os.makedirs(src)
    m = dt.timedelta(minutes=1)
    ev = spark.readStream.schema("event_id bigint, user_id bigint, ts timestamp, event_type string").parquet(src)
    out = match_within_stream(ev.where(F.col("event_type") == "click").drop("event_type"),
                              ev.where(F.col("event_type") == "view").drop("event_type"),
                              "user_id", 300, delay="2 minutes", shards=2)
    run_ = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
            .outputMode("append").trigger(availableNow=True))
    batches = [[(1, 1, T0 + 60 * m, "click")],
               [(2, 2, T0, "click"), (3, 2, T0 + m, "view")],     # both far behind the watermark
               [(4, 3, T0 + 120 * m, "click")]]
    for i, rows in enumerate(batches):
        pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "event_type"]).to_parquet(
            os.path.join(src, f"b{i}.parquet"), coerce_timestamps="us", allow_truncated_timestamps=True)
        run_.start().awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(sink).collect()) == [(1, 1, None, None)]


def test_final_matches_are_exact():
    from gatehouse.streaming.match_stream import REQUEST, RESPONSE, backwards, matches
    rnd = random.Random(5)
    limit = 300
    rows = [(BIG + i, rnd.choice(["a", "b", None]), rnd.randint(0, 3000)) for i in range(400)]
    q, r = rows[::2], rows[1::2]
    for split, size in ((1, 7), (1, 1000), (3, 16)):
        width = -(-limit // split)
        runs = {}
        for kind, part in ((REQUEST, [(t, str(i), k, t // width, None) for i, k, t in q]),
                           (RESPONSE, [(t, str(i), k, t // width - n, f"p{i}") for i, k, t in r for n in range(split + 1)])):
            rnd.shuffle(part)
            for half in (part[::2], part[1::2]):                # two batches, each in runs of its own
                half.sort(key=lambda e: e[0])
                for at in range(0, len(half), size):
                    runs[len(runs)] = [(t, kind, *e) for t, *e in half[at:at + size]]
        before, opened = 2500, []

        def load(n):
            opened.append(n)
            return runs[n]

        order = list(backwards([(e[-1][0], n) for n, e in runs.items()], load))
        assert sorted(opened) == sorted(runs) and [e[0] for e in order] == sorted((e[0] for e in order), reverse=True)
        got = {i: (resp, delay, load) for i, _, resp, delay, load in matches(iter(order), limit, before, True)}
        want = {}
        for i, k, t in q:
            if t < before:
                best = min(((t2 - t, j) for j, k2, t2 in r if k2 == k and k is not None and 0 <= t2 - t < limit), default=None)
                want[str(i)] = (str(best[1]), best[0], f"p{best[1]}") if best else (None, None, None)
        assert got == want


def test_stream_key_dense_in_one_bucket(spark, tmp_dir, monkeypatch):
    """A third of all events are one key's within one limit; runs far smaller than it; restarts and late rows."""
    import pandas as pd
    from pyspark.sql import functions as F

    from gatehouse.streaming import match_stream

    monkeypatch.setattr(match_stream, "RUN", 16)
    rnd = random.Random(12)
    us = dt.timedelta(microseconds=1)
    hot = [(i, 1, T0 + rnd.randint(0, 299_000_000) * us, rnd.choice(["click", "view"])) for i in range(400)]
    rest = [(1000 + i, rnd.randint(2, 30), T0 + rnd.randint(0, 4 * 3600 * 10**6) * us, rnd.choice(["click", "view"])) for i in range(800)]
    rows = hot + rest
    rnd.shuffle(rows)
    schema = "event_id bigint, user_id bigint, ts timestamp, event_type string"
    want = brute([r[:3] for r in rows if r[3] == "click"], [r[:3] for r in rows if r[3] == "view"], 300 * 10**6)
    end = [(5000, 99, T0 + dt.timedelta(hours=12), "click")]
    late = [(6000, 1, T0 + dt.timedelta(hours=1), "click"), (6001, 1, T0, "view")]          # far behind the watermark
    last = [(5001, 99, T0 + dt.timedelta(hours=20), "click")]
    for split, batches in ((1, [rows[:500], rows[500:], end, late, last]), (4, [rows, end, last])):
        src, sink, ck = (os.path.join(tmp_dir, f"{n}{split}") for n in ("in", "out", "ck"))
        os.makedirs(src)
        for i, batch in enumerate(batches):
            pd.DataFrame(batch, columns=["event_id", "user_id", "ts", "event_type"]).to_parquet(
                os.path.join(src, f"b{i}.parquet"), coerce_timestamps="us", allow_truncated_timestamps=True)
            ev = spark.readStream.schema(schema).parquet(src)
            out = match_stream.match_within_stream(ev.where(F.col("event_type") == "click").drop("event_type"),
                                                   ev.where(F.col("event_type") == "view").drop("event_type"),
                                                   "user_id", 300, delay="5 hours", shards=4, split=split)
            (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
             .outputMode("append").trigger(availableNow=True).start().awaitTermination())   # from the checkpoint each time
        got = {x.req_id: (x.user_id, x.resp_id, x.delay_us) for x in spark.read.parquet(sink).collect()}
        got.pop(5000, None)
        assert got == want


def test_stream_big_ids_null_keys_hot_key_and_restart(spark, tmp_dir):
    import pandas as pd
    from pyspark.sql import functions as F

    from gatehouse.streaming import match_within_stream

    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    os.makedirs(src)
    rnd = random.Random(8)
    s = dt.timedelta(seconds=1)
    rows = [(BIG + 2 * i, 1, T0 + rnd.randint(0, 6000) * s, rnd.choice(["click", "view"])) for i in range(300)]
    lost = [(7, None, T0 + 5 * s, "click"), (8, None, T0 + 6 * s, "view")]
    schema = "event_id bigint, user_id bigint, ts timestamp, event_type string"

    def start():
        ev = spark.readStream.schema(schema).parquet(src)
        out = match_within_stream(ev.where(F.col("event_type") == "click").drop("event_type"),
                                  ev.where(F.col("event_type") == "view").drop("event_type"),
                                  "user_id", 300, delay="3 hours", shards=5)
        (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())

    for i, batch in enumerate([rows[:150] + lost, rows[150:], [(1, 9, T0 + dt.timedelta(hours=9), "click")]]):
        pd.DataFrame(batch, columns=["event_id", "user_id", "ts", "event_type"]).astype(
            {"event_id": "Int64", "user_id": "Int64"}).to_parquet(
            os.path.join(src, f"b{i}.parquet"), coerce_timestamps="us", allow_truncated_timestamps=True)
        start()                                        # a new query each time, from the checkpoint
    got = {x.req_id: (x.user_id, x.resp_id, x.delay_us) for x in spark.read.parquet(sink).collect()}
    want = brute([r[:3] for r in rows if r[3] == "click"], [r[:3] for r in rows if r[3] == "view"], 300 * 10**6)
    assert got == {**want, 7: (None, None, None)}
