"""What each answer file holds, by name, overridden per lesson."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def artifact_kind(files: DataFrame, kinds: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Add ``kind`` to (task_id, name, ...) rows.

    ``kinds`` is (name, kind); ``exceptions`` is (task_id, name, kind) and wins
    over the name rule. An unknown name gives a null kind. The joins are left to
    the planner, which broadcasts tables it knows to be small.
    """
    k = kinds.select("name", F.col("kind").alias("_by_name"))
    e = exceptions.select("task_id", "name", F.col("kind").alias("_by_task"))
    return (files.join(e, ["task_id", "name"], "left").join(k, "name", "left")
            .withColumn("kind", F.coalesce("_by_task", "_by_name"))
            .drop("_by_task", "_by_name"))
