"""The judge as one stream: matching, parsing, classifying and the sink, over several batches, a restart and a replay."""

import datetime as dt
import glob
import os

import pandas as pd
from pyspark.sql import functions as F

from gatehouse.streaming import judge_within_stream, read_verdicts, write_verdict_stream
from gatehouse.streaming.judge_stream import verdict_folder

T0 = dt.datetime(2024, 1, 1)
M = dt.timedelta(minutes=1)
OK = '{"status":"success","message":"well \\"done\\" é"}'
COLUMNS = ["event_id", "user_id", "ts", "kind", "http_status", "transport_error", "body"]
SCHEMA = "event_id bigint, user_id bigint, ts timestamp, kind string, http_status int, transport_error string, body string"
BATCHES = [
    [(1, 1, T0, "q", None, None, None), (2, 1, T0 + M, "r", 200, None, OK), (3, 2, T0, "q", None, None, None),
     (4, 3, T0, "q", None, None, None), (5, 3, T0 + 6 * M, "r", 200, None, OK), (6, 4, T0, "q", None, None, None)],
    [(7, 4, T0 + 2 * M, "r", 500, None, OK), (8, 4, T0 + 3 * M, "r", 200, None, OK), (9, 5, T0 + M, "q", None, None, None),
     (10, 5, T0 + 2 * M, "r", None, "refused", None), (11, 6, T0, "q", None, None, None), (12, 6, T0, "r", 200, None, "{}"),
     (13, 7, T0, "q", None, None, None), (14, 7, T0 + M, "r", 200, None, "not json"),
     (15, 8, T0, "q", None, None, None), (16, 8, T0 + M, "r", 204, None, '{"status":"error","message":""}')],
    [(20, 9, T0 + 90 * M, "q", None, None, None)],
    [(21, 9, T0 + 300 * M, "q", None, None, None)],
]
WANT = {1: (2, "ok", "success", 'well "done" é', 0), 3: (None, None, "unreachable", None, 1), 4: (None, None, "unreachable", None, 1),
        6: (7, "ok", "http_error", 'well "done" é', 1), 9: (10, "malformed", "unreachable", None, 1), 11: (12, "unexpected", "unexpected", None, 1),
        13: (14, "malformed", "malformed", None, 1), 15: (16, "ok", "error", "", 1), 20: (None, None, "unreachable", None, 1)}


def stream(spark, src, out, ck):
    ev = spark.readStream.schema(SCHEMA).parquet(src)
    verdicts = judge_within_stream(ev.where("kind = 'q'").select("event_id", "user_id", "ts"), ev.where("kind = 'r'").drop("kind"),
                                   "user_id", 300, delay="10 minutes", shards=3)
    write_verdict_stream(verdicts, out, ck, available_now=True).awaitTermination()
    return verdicts.schema


def test_batches_restart_and_replay(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    os.makedirs(src)
    for i, batch in enumerate(BATCHES):
        pd.DataFrame(batch, columns=COLUMNS).astype({"http_status": "Int32", "transport_error": "string", "body": "string"}).to_parquet(
            os.path.join(src, f"b{i}.parquet"), coerce_timestamps="us", allow_truncated_timestamps=True)
        schema = stream(spark, src, out, ck)                    # a new query each time, from the checkpoint

    def rows():
        got = read_verdicts(spark, out, schema).collect()
        return sorted((r.req_id, r.resp_id, r.shape, r.outcome, r.message, r.exit_code) for r in got)

    want = sorted((k, *v) for k, v in WANT.items())
    assert rows() == want
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{ck}/commits/*"))
    for p in (f"{ck}/commits/{last}", f"{ck}/commits/.{last}.crc"):
        if os.path.exists(p):
            os.remove(p)                                        # as if the query had died after the write
    stream(spark, src, out, ck)
    assert rows() == want


def test_a_batch_written_twice_is_there_once(spark, tmp_dir):
    df = spark.createDataFrame([(1, "success"), (2, "error")], "req_id bigint, outcome string")
    put = verdict_folder(f"{tmp_dir}/v")
    put(df, 0)
    put(df.where("req_id = 1"), 1)
    put(df, 0)
    got = spark.read.parquet(f"{tmp_dir}/v").groupBy("batch").agg(F.count("*").alias("n")).collect()
    assert {int(r.batch): r.n for r in got} == {0: 2, 1: 1}
