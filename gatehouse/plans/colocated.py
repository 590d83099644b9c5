"""Tables that lie together: the screen's inputs bucketed by submission.

The screen groups and joins by ``sub_id`` throughout. Where its inputs are screened
more than once, they are stored in as many buckets each, dealt and sorted by ``sub_id``;
then every join and aggregate finds its rows in place and nothing is exchanged by
submission. A bucket is a task's input, so their number is sized to the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatehouse.operators.screen import screen
from gatehouse.session import shared_dir

# A table bucketed by sub_id may serve a join on (sub_id, path).
SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def store(df: DataFrame, table: str, buckets: int, key: str = "sub_id") -> DataFrame:
    """Write ``df`` as ``table``, bucketed and sorted by ``key``, into the shared folder; the table read back."""
    spark = df.sparkSession
    # dealt as the buckets are, so each task writes one file
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", shared_dir(spark, table)).mode("overwrite").saveAsTable(table))
    return spark.table(table)


def screen_colocated(tasks: DataFrame, default_base_url: str, submissions: DataFrame, explicit: DataFrame,
                     overrides: DataFrame, contents: DataFrame, **options) -> DataFrame:
    """X4 over stored tables: the last four are from :func:`store`, in the same number of buckets, ``overrides``
    by ``key`` and ``contents`` (sub_id, path, content, readable) by submission."""
    spark: SparkSession = submissions.sparkSession
    spark.conf.set(SUBSET_KEYS, "false")
    return screen(submissions, explicit, F.broadcast(tasks), overrides, default_base_url, contents, keys=("sub_id", "path"), **options)
