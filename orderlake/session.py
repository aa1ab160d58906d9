"""Spark session defaults for orderlake jobs."""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

# Settings every job relies on: AQE for runtime re-planning and skew joins,
# UTC so that text timestamps round-trip identically on every executor.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE merges small shuffle partitions up to this floor; 1 MB (the default)
    # turns the few-MB shuffles of a small load into 1-3 tasks of heavy
    # per-row work. Large shuffles are far above either value.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "orderlake", extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session; a folder is only set
    here when none is configured (local tests), never overriding the cluster.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not fallback and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = fallback or tempfile.mkdtemp(prefix="orderlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


#: Spark deletes the shuffle files of a query when the query ends, not when the driver happens to collect garbage.
FREED_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Partitioned tables are written with so many files open at a time in a task; else Spark sorts all rows by partition first.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

_set: dict[str, WeakKeyDictionary] = {FREED_SHUFFLES: WeakKeyDictionary(), OPEN_FILES: WeakKeyDictionary()}
_set_lock = threading.Lock()


@contextmanager
def _setting(spark: SparkSession, name: str, value: str, default: str) -> Iterator[None]:
    """Within, a setting of the session has a value. May be nested and entered by several threads; after the last the
    session's own setting holds again."""
    sessions = _set[name]
    with _set_lock:
        users, before = sessions.get(spark, (0, spark.conf.get(name, default)))
        sessions[spark] = (users + 1, before)
        spark.conf.set(name, value)
    try:
        yield
    finally:
        with _set_lock:
            users, before = sessions.pop(spark)
            if users > 1:
                sessions[spark] = (users - 1, before)
            else:
                spark.conf.set(name, before)


def freed_shuffles(spark: SparkSession):
    """Within, each write frees its shuffle files when it ends, so that a chain of writes holds those of one step on disk,
    not the sum over all."""
    return _setting(spark, FREED_SHUFFLES, "true", "false")


def unsorted_writes(spark: SparkSession):
    """Within, tables of a few partitions are written without a sort of their rows; of more the rest is sorted as ever."""
    return _setting(spark, OPEN_FILES, "4", "0")
