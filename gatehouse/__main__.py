"""Command-line entry for the jobs (``python -m gatehouse`` or spark-submit).

    python -m gatehouse screen   --input DIR --out PATH   # reasons per submission (Parquet)
    python -m gatehouse assemble --input DIR --out PATH   # request objects (JSON Lines, S3)
    python -m gatehouse judge    --input DIR --out PATH   # verdicts by outcome (Parquet, S4)
    python -m gatehouse match    --input DIR --out PATH [--seconds 300]

``DIR`` holds the input tables as ``<name>.parquet``. The session is taken as
configured by spark-submit; ``--master`` is for local runs. Outputs must not
exist yet (a re-run writes a new folder), so a failed run never leaves a
half-replaced result behind.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F


def run(argv: list[str]) -> int:
    p = argparse.ArgumentParser(prog="gatehouse")
    p.add_argument("job", choices=["screen", "assemble", "judge", "match"])
    p.add_argument("--input", required=True, help="folder with the input tables")
    p.add_argument("--out", required=True, help="output folder (must not exist)")
    p.add_argument("--seconds", type=float, default=300, help="match: time limit")
    p.add_argument("--master", default=None, help="local runs only, e.g. local[8]")
    a = p.parse_args(argv)

    from gatehouse.plans import fixtures as fx
    from gatehouse.plans.jobs import assemble_job, judge_job, screen_job
    from gatehouse.session import build_session, scratch
    from gatehouse.sources.sinks import write_requests, write_verdicts

    spark = build_session(a.master, app_name=f"gatehouse-{a.job}")
    with scratch(spark):            # intermediate tables go once the result is written
        if a.job == "screen":
            (screen_job(spark, a.input).select("sub_id", "task_id", "base_url", "reason", "fail_pos")
             .write.mode("errorifexists").parquet(a.out))
        elif a.job == "assemble":
            write_requests(assemble_job(spark, a.input), a.out)
        elif a.job == "judge":
            write_verdicts(judge_job(spark, a.input).select("sub_id", "message", "exit_code", "outcome"), a.out)
        else:
            from gatehouse.operators.match import match_within
            e = fx.table(spark, a.input, "events").select("event_id", "user_id", "ts", "event_type")
            q = e.where(F.col("event_type") == "click").drop("event_type")
            r = e.where(F.col("event_type") == "view").drop("event_type")
            (match_within(q, r, "user_id", a.seconds)
             .write.mode("errorifexists").parquet(a.out))
    return 0


if __name__ == "__main__":
    sys.exit(run(sys.argv[1:]))
