"""Session construction and the shared scratch location.

Everything that must outlive a task (sink round trips, staged inputs, stream
checkpoints) goes under the folder the cluster names in ``spark.checkpoint.dir``.
That folder is read from the session; a private one is set only when the
session has none (local tests).
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every lakemart job wants regardless of cluster size.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.maxMetadataStringLength": "1000",  # explain() shows the filters on directories whole
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "lakemart",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session with AQE, UTC and ANSI on and the UI off.

    ``master`` and ``shuffle_partitions`` are left to the cluster when None.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Order: the session's ``spark.checkpoint.dir``, then a directory already set on
    the context, and only on a local master a new private folder. On a cluster
    a folder of one machine would lose data, so there a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors share (master {master})")
        root = tempfile.mkdtemp(prefix="lakemart-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root. The driver's file
    system client removes it when the application ends."""
    path = f"{checkpoint_root(spark)}/lakemart-scratch/{name}-{uuid.uuid4().hex[:12]}"
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system's scheme and host, without a closing slash."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(jpath).toString().rstrip("/")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def cut_lineage(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and return
    its read-back. Use where one intermediate feeds several branches: every
    branch then scans the written files instead of recomputing the inputs,
    and a lost executor only re-reads files instead of replaying the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]):
    """Set session settings for the duration of a block, then restore them."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
