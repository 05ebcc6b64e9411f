"""Spark session set-up shared by tests, the bench and the entry module."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local = threading.local()

# Used only where the session names no folder (a path of fs.defaultFS).
DEFAULT_CHECKPOINT_DIR = "/tmp/checkpoints"

# Spark's setting that removes the shuffle files of a query at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings every job relies on. AQE re-plans joins at runtime: a side is
# broadcast only when its measured size is under the threshold, otherwise
# the join stays a sort-merge join and skewed partitions are split.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # For DataFrame.checkpoint(); tables of stage_table go with stage_only or
    # release_checkpoints.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ludex", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster deployment keeps whatever its launcher configured.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this application.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset (as
    in tests) the folder is ``/tmp/checkpoints`` of the default file system:
    a shared folder when that is HDFS or an object store, the local disk in
    a single-process session. A cluster whose default file system is local
    has no shared folder unless it names one, which is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None) or DEFAULT_CHECKPOINT_DIR
    if path == DEFAULT_CHECKPOINT_DIR and not sc.master.split("[")[0] == "local":
        if sc._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...)")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared checkpoint folder; it goes away with
    ``release_checkpoints``."""
    return f"{ensure_checkpoint_dir(spark)}/tables/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: cuts the lineage like ``checkpoint()``, compressed and by column.
    The write is an action; lost executors only rerun their own tasks. Its shuffle
    files go with it, as nothing reads them after the write."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    if _recording():
        _recording()[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def _recording() -> list[list[str]]:
    """Per thread: the paths staged inside each open ``stage_only``."""
    if not hasattr(_local, "paths"):
        _local.paths = []
    return _local.paths


def stage_only(build: Callable[[], DataFrame], label: str = "stage") -> DataFrame:
    """``stage_table(build())``, after which every table that ``build`` staged
    on the way is deleted: only the result reads on."""
    stack = _recording()
    stack.append([])
    try:
        df = build()
        mine = stack.pop()
        stack.append([])  # the result is not one of the tables to delete
        out = stage_table(df, label)
    finally:
        last = stack.pop()
    if stack:
        stack[-1].extend(last)
    for path in mine:
        _delete(out.sparkSession, path)
    return out


@contextmanager
def staged_paths() -> Iterator[list[str]]:
    """The paths of the tables staged inside, for ``drop_tables``. Those that are
    not dropped are the enclosing ``stage_only``'s to delete."""
    stack = _recording()
    stack.append(paths := [])
    try:
        yield paths
    finally:
        stack.pop()
        if stack:
            stack[-1].extend(paths)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    for path in paths:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def release_checkpoints(spark: SparkSession) -> None:
    """Delete this application's own checkpoint subfolder (Spark makes one
    per SparkContext under ``spark.checkpoint.dir``) at the end of a job, with
    the staged tables that the results still read."""
    path = spark.sparkContext.getCheckpointDir()
    if path:
        _delete(spark, path)
