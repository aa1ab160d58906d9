"""Scratch tables, table reading and grouped Arrow streams shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Setting of an Arrow batch's size, and its default.
BATCH_BYTES, DEFAULT_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: A batch of this package: the JVM and the worker each hold some copies of one, and an executor has a worker for each core.
OWN_BATCH = "4m"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder path under spark.checkpoint.dir.

    Where the setting is missing, a local session (tests) gets a temporary
    folder; on a cluster that would be a folder of one machine, so it raises.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="orderlake-llm-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame to a scratch table and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, most_rows: int) -> DataFrame:
    """A landed frame, to be broadcast if it has no more than most_rows rows; else Spark shuffles it."""
    return F.broadcast(df) if df.count() <= most_rows else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_workers(spark: SparkSession) -> SparkSession:
    """A session whose Python workers find this package, also when the driver's folder is another,
    and get batches of bounded size (a batch of long texts is many times its bytes in Python)."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    if spark.conf.get(BATCH_BYTES, DEFAULT_BATCH) in (DEFAULT_BATCH, "64MB"):
        spark.conf.set(BATCH_BYTES, OWN_BATCH)
    return spark


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], most_rows: int = 4096) -> Iterator[pa.Table]:
    """Cut a stream that is sorted by ``keys`` into tables of whole groups.

    A table holds as many whole groups as fit into about ``most_rows`` rows,
    or one group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        changed = [False] * batch.num_rows
        for column in columns:
            values = column.to_pylist()
            for i in range(1, len(values)):
                if values[i] != values[i - 1]:
                    changed[i] = True
        cuts = [i for i, c in enumerate(changed) if c]
        if held:
            last = held[-1]
            if any(last.column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
                yield pa.Table.from_batches(held)
                held = []
        done = 0
        for i, cut in enumerate(cuts):
            following = cuts[i + 1] if i + 1 < len(cuts) else None
            if cut - done >= most_rows or following is None or following - done > most_rows:
                yield pa.Table.from_batches([*held, batch.slice(done, cut - done)])
                held, done = [], cut
        held.append(batch.slice(done))
    if held:
        yield pa.Table.from_batches(held)


def arrow(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], df: DataFrame, schema: str) -> DataFrame:
    """mapInArrow over a frame."""
    with_workers(df.sparkSession)
    return df.mapInArrow(fn, schema)
