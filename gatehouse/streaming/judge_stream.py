"""The judge as one stream: requests and responses are matched within the limit (T1), each
answer is parsed (X1), classified (X2, X3) and written as a verdict (S4).

A request that got no answer in time is ``unreachable``. The sink writes each micro-batch
into a folder of its own, named by its number and replaced as a whole: a batch that runs
again after a failure writes the same verdicts to the same place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gatehouse.functions.verdict import classify, exit_code, with_verdict
from gatehouse.sources.sinks import open_writers
from gatehouse.streaming.match_stream import match_within_stream

REPLY = "struct<http_status: int, transport_error: string, body: string>"


def judge_within_stream(requests: DataFrame, responses: DataFrame, key: str, seconds: float, id_col: str = "event_id",
                        **options) -> DataFrame:
    """Streaming (req_id, <key>, resp_id, shape, status, message, outcome, exit_code), one row a request.

    ``responses`` has ``http_status``, ``transport_error`` and ``body`` besides the columns of
    :func:`match_within_stream`, which takes ``options``. Only the answer that counts is parsed; a request without
    one has null ``resp_id`` and ``shape``. A response without status and error is ``unreachable``, as in the batch judge.
    """
    reply = F.to_json(F.struct(F.col("http_status").cast("int").alias("http_status"), F.col("transport_error").cast("string").alias("transport_error"),
                               F.col("body").cast("string").alias("body")))
    found = match_within_stream(requests, responses, key, seconds, id_col=id_col, payload=reply, **options)
    answer = F.from_json("payload", REPLY, {"maxStringLen": "2147483647"})
    late = F.when(F.col("resp_id").isNull(), "timeout")
    parts = found.withColumn("_reply", answer).select(
        "req_id", key, "resp_id", "_reply.http_status", F.coalesce("_reply.transport_error", late).alias("transport_error"), "_reply.body")
    judged = with_verdict(parts, "body").withColumn("outcome", classify("http_status", "transport_error", F.col("verdict")))
    shape = F.when(F.col("resp_id").isNotNull(), F.col("verdict.shape")).alias("shape")
    return judged.select("req_id", key, "resp_id", shape, "verdict.status", "verdict.message", "outcome",
                         exit_code("outcome").cast("bigint").alias("exit_code"))


def verdict_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the verdicts of batch n as Parquet by outcome in ``<path>/batch=n``, replaced whole."""
    def put(verdicts: DataFrame, batch: int) -> None:
        with open_writers(verdicts.sparkSession):
            (verdicts.hint("rebalance", F.col("outcome")).write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("outcome").parquet(f"{path.rstrip('/')}/batch={batch}"))
    return put


def write_verdict_stream(verdicts: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Start writing a stream of verdicts to ``path`` (S4), each exactly once."""
    writer = verdicts.writeStream.foreachBatch(verdict_folder(path)).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_verdicts(spark, path: str, schema) -> DataFrame:
    """What :func:`write_verdict_stream` has written; ``schema`` is that of its stream."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
