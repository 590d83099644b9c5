"""Intermediate tables are dropped with their block, and only those."""

import os

import pytest

from gatehouse.session import scratch, shared_table


def _folder(df):
    return os.path.dirname(df.inputFiles()[0]).removeprefix("file:").replace("///", "/")


def test_scratch_drops_what_was_made_inside(spark, tmp_dir):
    kept = shared_table(spark.range(5), "kept")
    with scratch(spark):
        inner = shared_table(spark.range(7), "inner")
        place = _folder(inner)
        inner.write.parquet(f"{tmp_dir}/out")
        assert os.path.isdir(place)
    assert not os.path.exists(place) and os.path.isdir(_folder(kept))
    assert kept.count() == 5 and spark.read.parquet(f"{tmp_dir}/out").count() == 7


def test_scratch_keeps_folders_after_an_error(spark):
    with pytest.raises(ValueError):
        with scratch(spark):
            place = _folder(shared_table(spark.range(3), "failed"))
            raise ValueError
    assert os.path.isdir(place)
