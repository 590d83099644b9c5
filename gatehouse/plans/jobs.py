"""The three jobs: screen (X4), assemble (P6 over A2) and judge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatehouse.functions.text import rstrip_slash, strip
from gatehouse.functions.urls import target_url

from gatehouse.functions.verdict import classify, exit_code, with_verdict
from gatehouse.operators.bundle import check_arity, request_json, submission_headers
from gatehouse.operators.screen import screen
from gatehouse.plans import fixtures as fx


def arity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = fx.submissions(spark, sf_dir)
    return check_arity(submission_headers(subs), fx.explicit_files(spark, sf_dir), fx.tasks(spark))


def screen_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every submission with its first failing rule (null = may be sent)."""
    return screen(fx.submissions(spark, sf_dir), fx.explicit_files(spark, sf_dir),
                  fx.tasks(spark), fx.overrides(spark, sf_dir), fx.DEFAULT_BASE_URL,
                  fx.stored_files(spark, sf_dir), listed=True)


def assemble_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sub_id, task_id, target_url, request) per submission that passes the screen.

    ``target_url`` is where the request goes: the stripped base address (P1,
    P2) followed by the task's endpoint (P3).

    A bundle task sends its files as a JSON map name -> text; any other task
    sends the one file's text. Newlines are normalised as in text-mode reads.
    Runs on the screen's own pass (one aggregate per submission); every
    submission that may be sent has a request.
    """
    s = screen(fx.submissions(spark, sf_dir), fx.explicit_files(spark, sf_dir),
               fx.tasks(spark), fx.overrides(spark, sf_dir), fx.DEFAULT_BASE_URL,
               fx.stored_files(spark, sf_dir), collect_bundles=True, listed=True)
    solution = F.when(F.col("bundle"), F.col("solution")).otherwise(F.col("single_text"))
    target = target_url(rstrip_slash(strip("base_url")), "endpoint")
    return (s.where(F.col("reason").isNull())
            .select("sub_id", "task_id", target.alias("target_url"),
                    request_json("student_id", solution).alias("request")))


def judge(responses: DataFrame) -> DataFrame:
    """X1-X3 over (sub_id, http_status, transport_error, body) rows.

    Stateless, so the same plan runs on a batch frame or a ``readStream`` frame.
    """
    verdicts = with_verdict(responses.select("sub_id", "http_status", "transport_error", "body"), "body")
    return (verdicts.withColumn("outcome", classify("http_status", "transport_error", F.col("verdict")))
            .select("sub_id", "verdict.shape", "verdict.status", "verdict.message", "outcome",
                    exit_code("outcome").cast("bigint").alias("exit_code")))


def judge_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sub_id, shape, status, message, outcome, exit_code) per service response."""
    return judge(fx.responses(spark, sf_dir))
