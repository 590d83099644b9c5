"""Session factory and the few settings our semantics depend on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on for correct results (not tuning):
#  - UTC session time zone: event-time casts from timestamp_ntz (T1, J3);
#  - LAST_WIN map dedup: a repeated file name in a bundle keeps the last text,
#    like a Python dict built from pairs (A2);
#  - duplicate JSON keys allowed, last one wins, like Python's json module.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # keys in folder names stay text: 007 and 7 are two keys
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Runtime re-planning: AQE coalesces small shuffle partitions, splits skewed
# sort-merge join partitions, and turns a sort-merge join into a broadcast
# join only when the *measured* build side is below the threshold.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when an aggregate on the same key
    # follows (that costs one more shuffle, far less than one task doing a
    # third of the work)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def build_session(master: str | None = None, app_name: str = "gatehouse",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with our semantic and scale settings.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset so the cluster's own values apply.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SCALE_CONF, **SEMANTIC_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # listing many small artifact folders: a few listing tasks per core rather
    # than one task per folder (the default allows up to 10000 tasks)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism",
                   str(max(8, spark.sparkContext.defaultParallelism * 4)))
    ensure_semantics(spark)
    return spark


def ensure_semantics(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to a session we did not build."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only when the session names none and runs in one process (``local`` master:
    tests) do we make one under the system temp folder. On a cluster that
    would be a folder of one machine, so a missing setting is an error.
    """
    sc = spark.sparkContext
    base = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())
    if base:
        return base
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="gatehouse-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory.

    Used for written tables (sink round trips, streaming checkpoints); never a
    machine-local folder on a cluster.
    """
    path = f"{checkpoint_base(spark).rstrip('/')}/gatehouse/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


_made: list[str] = []       # the folders handed out, in order


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop the intermediate tables made inside the ``with`` block when it ends without an error.

    Results must have been written to a place of their own by then: a frame that
    still reads an intermediate table cannot be used any longer. After an
    error the folders stay, so that a job can be looked into.
    """
    since = len(_made)
    yield
    for path in _made[since:]:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    del _made[since:]


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage is cut there."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (any scheme)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def mark_done(spark: SparkSession, path: str) -> None:
    """An empty ``_SUCCESS`` file in the folder ``path``."""
    fs, p = _fs(spark, f"{path}/_SUCCESS")
    fs.create(p).close()


def file_signature(spark: SparkSession, path: str) -> str:
    """Size and modification time of a file or folder, for naming derived data."""
    fs, p = _fs(spark, path)
    st = fs.getContentSummary(p)
    return f"{st.getLength()}-{fs.getFileStatus(p).getModificationTime()}"
