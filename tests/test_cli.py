"""The job entry point writes each job's output through the sinks."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_jobs_write_outputs(spark, tmp_dir):
    from gatehouse.__main__ import run
    import __spark_entry__ as e

    for job in ["screen", "assemble", "judge", "match"]:
        assert run([job, "--input", SF, "--out", os.path.join(tmp_dir, job)]) == 0
    assert spark.read.parquet(os.path.join(tmp_dir, "screen")).count() == e.queries()["x4_screen"](spark, SF).count()
    reqs = spark.read.text(os.path.join(tmp_dir, "assemble"))
    assert reqs.count() == e.queries()["p6_request_json"](spark, SF).where("request is not null").count()
    assert spark.read.parquet(os.path.join(tmp_dir, "judge")).count() == e.queries()["x2_classify"](spark, SF).count()
    assert spark.read.parquet(os.path.join(tmp_dir, "match")).count() == \
        e.queries()["j3_match_within_300s"](spark, SF).count()
    with pytest.raises(Exception):          # outputs are never overwritten
        run(["judge", "--input", SF, "--out", os.path.join(tmp_dir, "judge")])
