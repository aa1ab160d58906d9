"""Materialise derived tables once, in the cluster's shared folder.

A derived table (a landed Bronze view, a Silver table) is written as Parquet
under ``spark.checkpoint.dir`` and read back, which cuts the lineage: later
queries scan the written files instead of recomputing the whole chain, and
a lost executor only costs the tasks of the current stage. The folder name
carries a fingerprint of the inputs (paths, sizes, modification times), of this
package's code and of the contract, so a changed source or rule lands again
instead of serving stale rows. A table is written beside its place and renamed
when it is whole.
"""

from __future__ import annotations

import functools
import hashlib
import os
import uuid
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from orderlake.session import ensure_checkpoint_dir, freed_shuffles

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds, sorted; none if there is no folder."""
    fs, p = _fs(spark, folder)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def create_whole(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its content in one step; False if it is there already.

    The content is written beside and put in place by an operation that fails where the name is taken: a hard
    link on a local disk, a rename elsewhere (atomic on HDFS; an object store needs a client that offers it).
    Of several writers exactly one gets True, and no reader sees half a file.
    """
    fs, p = _fs(spark, path)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.getUri().getScheme() == "file":
        try:
            os.link(aside.toUri().getPath(), p.toUri().getPath())
            made = True
        except FileExistsError:
            made = False
    else:
        made = not fs.exists(p) and bool(fs.rename(aside, p))
    if fs.exists(aside):
        fs.delete(aside, False)
    return made


def read_small(spark: SparkSession, path: str) -> str:
    """Content of a small file of this package (a pointer, a manifest)."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def built_once(spark: SparkSession, path: str, build: Callable[[str], None]) -> str:
    """``path``, after ``build(folder)`` has filled it: built beside and renamed when whole, so that a build
    that is killed leaves nothing under the name."""
    if not path_exists(spark, path):
        made = f"{path}.{uuid.uuid4().hex}"
        with freed_shuffles(spark):
            build(made)
        fs, p = _fs(spark, made)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not fs.exists(target):  # else another build has finished it meanwhile
            fs.rename(p, target)
    return path


def write_aside(spark: SparkSession, aside: str, folder: str, write: Callable[[str], None]) -> None:
    """Add a subfolder to ``folder`` that ``write`` has filled, by one rename from ``aside``."""
    name = uuid.uuid4().hex
    write(f"{aside}/{name}")
    fs, p = _fs(spark, f"{aside}/{name}")
    fs.mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder))
    fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))


@functools.cache
def code_version() -> str:
    """Identity of the code that makes the tables: a hash of this package's modules."""
    h = hashlib.sha256()
    root = Path(__file__).resolve().parents[1]
    for path in sorted(root.rglob("*.py")):
        if "llm" not in path.relative_to(root).parts:
            h.update(path.read_bytes())
    return h.hexdigest()[:8]


def fingerprint_paths(spark: SparkSession, paths: Sequence[str], *more: object) -> str:
    """Cheap identity of input files (path, length and modification time, in all
    subfolders), of the code and of ``more`` (a contract, say)."""
    h = hashlib.sha256(repr((code_version(), more)).encode())
    for path in sorted(paths):
        fs, p = _fs(spark, path)
        h.update(path.encode())
        if fs.exists(p):
            files = fs.listFiles(p, True)
            found = []
            while files.hasNext():
                st = files.next()
                found.append(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
            h.update("\n".join(sorted(found)).encode())
    return h.hexdigest()[:16]


def scratch(df: DataFrame) -> DataFrame:
    """Write a frame to a new folder of the cluster's shared folder and read it back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/orderlake-scratch/{uuid.uuid4().hex}"
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialized(spark: SparkSession, name: str, inputs: Sequence[str], build: Callable[[], DataFrame],
                 partition_by: Sequence[str] = (), version: object = None) -> DataFrame:
    """Write ``build()`` once per fingerprint and return a scan of it."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/orderlake-tables/{name}-{fingerprint_paths(spark, inputs, version)}"

    def write(made: str) -> None:
        writer = build().write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(made)
    return spark.read.parquet(built_once(spark, path, write))
