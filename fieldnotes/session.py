"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job wants. AQE re-plans joins and coalesces shuffle
# partitions from runtime sizes; skew-join splits oversized partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "fieldnotes", master: str | None = None,
              shuffle_partitions: int | None = None,
              conf: dict[str, str] | None = None, scratch: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``master`` is left to ``spark-submit`` unless given (tests pass
    ``local[*]``). ``shuffle_partitions`` is the job's parallelism knob,
    ``scratch`` the shared folder where the cluster names none.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        settings["spark.default.parallelism"] = str(shuffle_partitions)
    if scratch:
        settings["spark.checkpoint.dir"] = scratch
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, for checkpoints and
    written tables: ``spark.checkpoint.dir``, or the context's checkpoint
    folder. There is no machine-local fallback: without either, stop."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("no shared folder: set spark.checkpoint.dir to one that driver "
                           "and executors can all reach (jobs: --scratch)")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/fieldnotes/{name}-{uuid.uuid4().hex}"


@contextmanager
def staged(df, name: str):
    """A frame written as parquet under the shared folder and read back, for
    the time of a ``with`` block: lineage cut, and later column-sliced reads
    decode only their columns (a CSV source would be re-read whole by every
    slice). The files are deleted at the end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
