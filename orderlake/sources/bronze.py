"""Sources, sinks and load management.

A load of a source is a folder ``<source>/load_id=<id>/generation=<new id>``; what readers
see is decided by small manifest files ``_committed/<load id>.<number>``, each naming a
generation. Landing a load anew writes another generation and commits it by creating
the next manifest: a reader gets the old or the new generation, never none or half of one. Row and
column counts come from ``DataFrame.observe`` during the write, so landing never scans
a table twice.
"""

from __future__ import annotations

import functools
import itertools
import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from orderlake.operators.silver import ARRIVAL, content_columns
from orderlake.sources.landing import create_whole, names_in, path_exists, read_small, remove_path

#: A file of up to so many bytes is hashed as one cell; larger ones are read by so many bytes at a time.
CELL_BYTES, BUFFER_BYTES = 256 << 20, 8 << 20
#: Row hashes are summed in parts of so many bits.
PART_BITS = 22


class LoadExistsError(Exception):
    """A load with this id was already landed (S31); pass overwrite=True to replace it."""


class UnknownLoadError(ValueError):
    """The requested load does not exist; the message lists the available ones."""


# ------------------------------------------------------------------ A1, A2
def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int = 1,
              fetchsize: int = 10_000) -> DataFrame:
    """A1: full-table extract from a relational source, read in parallel slices
    of ``partition_column``; DECIMAL columns stay DECIMAL. (No database is
    available in this environment, so this reader is not exercised by tests.)"""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetchsize)
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return reader.load()


def read_text_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv",
                    corrupt_col: str = "_corrupt_record") -> DataFrame:
    """A2: a semi-structured file with a header, read with a DECLARED schema
    (no inference pass); malformed rows are kept with their raw text in
    ``corrupt_col`` (PERMISSIVE) instead of failing the load."""
    full = StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    if fmt == "csv":
        reader = (reader.option("header", True).option("ignoreLeadingWhiteSpace", False)
                  .option("ignoreTrailingWhiteSpace", False))
        return reader.csv(path)
    if fmt == "json":
        return reader.json(path)
    return spark.read.schema(schema).parquet(path)


def write_text_table(df: DataFrame, path: str) -> None:
    """Counterpart of A2 for tests and exports: CSV with header, blanks preserved."""
    (df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def with_arrival(df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """The rows of files with ``_arrival``: where and when each arrived, as (time of the file, file, start of the
    block, row). Landed with the rows, it decides which of several copies, versions or sales with one key is the first.

    From Spark's hidden file columns. Parquet tells a row's place in its file; text files don't, there the rows of a
    block are numbered in the order in which its task reads them.
    """
    row = F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()
    return df.select("*", F.struct(F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_path").alias("file"),
                                   F.col("_metadata.file_block_start").alias("block") if fmt != "parquet" else F.lit(0).cast("long").alias("block"),
                                   row.alias("row")).alias(ARRIVAL))


# ------------------------------------------------------------------ A3
def extraction_probe(df: DataFrame, source: str) -> DataFrame:
    """A3: rows and columns of an extracted source."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(source).alias("source"), "rows", F.lit(len(df.columns)).alias("columns"))


def extraction_columns(df: DataFrame, source: str) -> DataFrame:
    """A3: the names of an extracted source's columns, in order, with the number of filled cells."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    named = [F.struct(F.lit(at).alias("position"), F.lit(c).alias("column"), F.col(f"`{c}`").alias("filled")) for at, c in enumerate(df.columns, 1)]
    return counts.select(F.lit(source).alias("source"), F.inline(F.array(*named)))


def extraction_head(df: DataFrame, key_cols: Sequence[str], k: int = 5) -> DataFrame:
    """A3: the first ``k`` rows by key (a top-k, planned as TakeOrdered; ``k`` is the feature)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in [*key_cols, *df.columns]]).limit(k)


def repeatable_sample(df: DataFrame, key_cols: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """A3: a seeded sample of ``k`` rows that does not depend on partitioning: the k smallest
    md5 of key and seed, of rows with one key the first by all columns (a top-k, planned as TakeOrdered)."""
    drawn = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in key_cols], F.lit(str(seed))).cast("binary"))
    return df.orderBy(drawn, *[F.col(c).asc_nulls_first() for c in df.columns]).limit(k)


# ------------------------------------------------------------------ A4
def write_counted(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> dict:
    """A4: write Parquet and return rows x columns observed during the write."""
    obs = Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return {"path": path, "rows": int(obs.get["rows"]), "columns": len(df.columns)}


# ------------------------------------------------------------------ A9
def content_fingerprint_expr(cols: Sequence[str]) -> list:
    """Order-insensitive table fingerprint: row count + exact sum of 64-bit row hashes.

    The hashes are summed in three parts, as whole numbers (up to 2^41 rows), and put together once."""
    h = F.xxhash64(*[F.col(c) for c in cols])
    low = F.lit((1 << PART_BITS) - 1).cast("bigint")
    parts = [h.bitwiseAND(low), F.shiftright(h, PART_BITS).bitwiseAND(low), F.shiftright(h, 2 * PART_BITS)]
    whole = [F.sum(part).cast("decimal(20,0)") * F.lit(1 << at * PART_BITS).cast("decimal(15,0)") for at, part in enumerate(parts)]
    return [F.count(F.lit(1)).alias("rows"), (whole[0] + whole[1] + whole[2]).cast("decimal(38,0)").cast("string").alias("hash_sum")]


def row_sha256(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per-row SHA-256 over a canonical text form (NULL as ``\\N``)."""
    cols = list(cols or df.columns)
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols])
    return df.select(*cols, F.sha2(text, 256).alias("row_sha256"))


def file_sha256(spark: SparkSession, path_glob: str, cell_bytes: int = CELL_BYTES, buffer_bytes: int = BUFFER_BYTES) -> DataFrame:
    """A9 for files: path, length and SHA-256 of each file's bytes.

    A file of up to ``cell_bytes`` is one cell of the ``binaryFile`` source. A larger one, of any size, is read by its task
    as a stream of ``buffer_bytes`` at a time through Arrow's file systems (local, HDFS, S3, ...); the filter on the length
    keeps its content out of the cells. A file that changes its length between listing and reading is an error.
    Spark's sources don't list empty files, so these have no row.
    """
    files = spark.read.format("binaryFile").load(path_glob)

    def streamed(batches):  # nested, so that a worker needs no import of this package
        import hashlib

        import pyarrow as pa
        from pyarrow import fs

        def digest(path: str, length: int) -> str:
            scheme, _, rest = path.partition(":")
            authority, _, inner = rest[2:].partition("/") if rest.startswith("//") else ("", "", rest.lstrip("/"))
            if scheme == "file":
                system, base = fs.LocalFileSystem(), ""
            else:
                system, base = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{authority}/")
            hashed, done = hashlib.sha256(), 0
            with system.open_input_stream(f"{base.rstrip('/')}/{inner}") as stream:
                while chunk := stream.read(buffer_bytes):
                    hashed.update(chunk)
                    done += len(chunk)
            if done != length:
                raise OSError(f"{path} has {done} bytes, {length} were listed")
            return hashed.hexdigest()

        for batch in batches:
            found = [digest(*row.values()) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], ["path", "length", "sha256"])

    cells = files.where(F.col("length") <= cell_bytes).select("path", "length", F.sha2(F.col("content"), 256).alias("sha256"))
    large = files.where(F.col("length") > cell_bytes).select("path", "length")
    return cells.unionByName(large.mapInArrow(streamed, "path string, length long, sha256 string"))


# ------------------------------------------------------------------ A5-A8
def land_load(spark: SparkSession, bronze_root: str, sources: dict[str, DataFrame], load_id: str,
              overwrite: bool = False) -> list[dict]:
    """A5 (+A4, A9, A10): land every source under ``load_id``, as a new generation that is committed as a whole.

    Row count and content fingerprint are observed during the write.
    """
    if not overwrite and load_id in committed_loads(spark, bronze_root):
        raise LoadExistsError(f"load {load_id} already exists")
    generation = uuid.uuid4().hex

    def land_one(name: str, df: DataFrame) -> dict:
        kind, origin = origin_of(df)
        df = conform_to_existing(spark, df, bronze_root, name)
        obs = Observation()
        content = content_columns(df)
        df.observe(obs, *content_fingerprint_expr(content)).write.parquet(_folder(bronze_root, name, load_id, generation))
        return {"source": name, "load_id": load_id, "rows": int(obs.get["rows"]),
                "columns": len(content), "fingerprint": f"{obs.get['rows']}:{obs.get['hash_sum']}", "kind": kind, "origin": origin}

    # the sources are independent: land them as concurrent jobs
    with ThreadPoolExecutor(max_workers=max(1, len(sources))) as pool:
        futures = [pool.submit(land_one, name, df) for name, df in sources.items()]
        facts = [f.result() for f in futures]
    commit_load(spark, bronze_root, load_id, generation, overwrite, {f["source"]: f["fingerprint"] for f in facts})
    return facts


def _folder(bronze_root: str, source: str, load_id: str, generation: str) -> str:
    return f"{bronze_root}/{source}/load_id={load_id}/generation={generation}"


def _manifests(spark: SparkSession, bronze_root: str) -> dict[str, list[int]]:
    """Numbers of the manifests of each load, ascending."""
    out: dict[str, list[int]] = {}
    for name in names_in(spark, f"{bronze_root}/_committed"):
        load_id, _, number = name.rpartition(".")
        if load_id and number.isdigit():
            out.setdefault(load_id, []).append(int(number))
    return {k: sorted(v) for k, v in out.items()}


def _manifest(bronze_root: str, load_id: str, number: int) -> str:
    return f"{bronze_root}/_committed/{load_id}.{number:06d}"


def _committed(spark: SparkSession, bronze_root: str, load_id: str, number: int) -> tuple[str, dict[str, str]]:
    """Generation and fingerprints that a manifest names."""
    generation, fingerprints = json.loads(read_small(spark, _manifest(bronze_root, load_id, number)))
    return generation, fingerprints


def commit_load(spark: SparkSession, bronze_root: str, load_id: str, generation: str, overwrite: bool = False,
                fingerprints: dict[str, str] | None = None) -> None:
    """Make a generation of a load visible, with the fingerprints of its sources: all of them have landed. Of the earlier generations
    the last stays for readers that have begun, older ones are deleted."""
    while True:
        numbers = _manifests(spark, bronze_root).get(load_id, [])
        if numbers and not overwrite:
            raise LoadExistsError(f"load {load_id} already exists")
        if create_whole(spark, _manifest(bronze_root, load_id, (numbers or [0])[-1] + 1), json.dumps([generation, fingerprints or {}])):
            break
    for number in numbers[:-1]:
        old = _committed(spark, bronze_root, load_id, number)[0]
        for source in names_in(spark, bronze_root):
            remove_path(spark, _folder(bronze_root, source, load_id, old))
        remove_path(spark, _manifest(bronze_root, load_id, number))


def committed_loads(spark: SparkSession, bronze_root: str) -> set[str]:
    return set(_manifests(spark, bronze_root))


def load_folder(spark: SparkSession, bronze_root: str, source: str, load_id: str) -> str | None:
    """Folder of the committed generation of a load, or None."""
    numbers = _manifests(spark, bronze_root).get(load_id)
    if not numbers:
        return None
    folder = _folder(bronze_root, source, load_id, _committed(spark, bronze_root, load_id, numbers[-1])[0])
    return folder if path_exists(spark, folder) else None


def conform_to_existing(spark: SparkSession, df: DataFrame, bronze_root: str, source: str) -> DataFrame:
    """Cast a new load to the schema of the newest landed one (one source, one physical type per
    column); a missing or extra column is an error."""
    ids = list_load_ids(spark, bronze_root, source)
    if not ids:
        return df
    target = {f.name: f.dataType for f in spark.read.parquet(load_folder(spark, bronze_root, source, ids[-1])).schema.fields}
    if set(target) - {ARRIVAL} != set(content_columns(df)):
        raise ValueError(f"schema drift at {source}: expected {sorted(target)}, got {sorted(df.columns)}")
    target = {c: target.get(c, df.schema[c].dataType) for c in df.columns}
    return df.select(*[F.col(c).cast(target[c]).alias(c) if df.schema[c].dataType != target[c] else F.col(c)
                       for c in df.columns])


class ChangedLoadError(ValueError):
    """The landed files no longer hold what was landed."""


def origin_of(df: DataFrame) -> tuple[str, str]:
    """A10: kind and origin of a source: ``files`` and the folder that holds them (of several folders the deepest
    that holds all), or ``query`` and no origin for rows that are not read from files. Reads the plan alone."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    if not folders:
        return "query", ""
    first, last = (f.split("/") for f in (min(folders), max(folders)))
    same = [a for a, b in itertools.takewhile(lambda pair: pair[0] == pair[1], zip(first, last))]
    return "files", "/".join(same)


def verify_load(spark: SparkSession, bronze_root: str, load_id: str) -> list[str]:
    """Read a landed load again and compare each source with the fingerprint of its landing, which the load's
    manifest holds: one aggregate a source. Raises ``ChangedLoadError`` where rows were added, lost or changed since.
    Returns the sources compared."""
    numbers = _manifests(spark, bronze_root).get(load_id)
    if not numbers:
        raise UnknownLoadError(f"unknown load {load_id}")
    fingerprints = _committed(spark, bronze_root, load_id, numbers[-1])[1]
    for source, landed in sorted(fingerprints.items()):
        load = read_load(spark, bronze_root, source, load_id)
        found = load.agg(*content_fingerprint_expr(content_columns(load))).first()
        if f"{found['rows']}:{found['hash_sum']}" != landed:
            raise ChangedLoadError(f"{source} of load {load_id} holds {found['rows']}:{found['hash_sum']}, landed was {landed}")
    return sorted(fingerprints)


def list_loads(spark: SparkSession, bronze_root: str, source: str) -> DataFrame:
    """Loads oldest -> newest (``load_id`` sorts as time: YYYYMMDD_HHMMSS), from the folder listing."""
    return spark.createDataFrame([(x,) for x in list_load_ids(spark, bronze_root, source)], "load_id string")


def list_load_ids(spark: SparkSession, bronze_root: str, source: str) -> list[str]:
    """Ids of the whole loads of a source: its folders that are committed
    (metadata, bounded by retention). A load of which only some sources landed is not listed."""
    ids = {n.split("=", 1)[1] for n in names_in(spark, f"{bronze_root}/{source}") if n.startswith("load_id=")}
    return sorted(ids & committed_loads(spark, bronze_root))


def retention_plan(loads: DataFrame, max_loads: int) -> DataFrame:
    """Which loads fall outside the newest ``max_loads`` (S30: max_loads >= 1)."""
    if max_loads < 1:
        raise ValueError("max_loads must be >= 1")
    w = Window.orderBy(F.desc("load_id"))  # over the distinct load ids only: a bounded list
    return loads.withColumn("rank", F.dense_rank().over(w)).withColumn("drop", F.col("rank") > max_loads)


def apply_retention(spark: SparkSession, bronze_root: str, sources: Sequence[str], max_loads: int) -> list[str]:
    """Delete the partitions of loads beyond the newest ``max_loads``."""
    if max_loads < 1:
        raise ValueError("max_loads must be >= 1")
    dropped = set()
    for s in sources:
        ids = list_load_ids(spark, bronze_root, s)
        for lid in ids[:-max_loads] if len(ids) > max_loads else []:
            dropped.add(lid)
    manifests = _manifests(spark, bronze_root)
    for lid in sorted(dropped):  # first out of sight, then away
        for path in [*[_manifest(bronze_root, lid, n) for n in manifests[lid]], *[f"{bronze_root}/{s}/load_id={lid}" for s in sources]]:
            remove_path(spark, path)
    return sorted(dropped)


def read_load(spark: SparkSession, bronze_root: str, source: str, load_id: str | None = None) -> DataFrame:
    """One load of a source (its folder alone is read); default = newest; unknown raises."""
    ids = list_load_ids(spark, bronze_root, source)
    if not ids:
        raise UnknownLoadError(f"no loads for {source}")
    lid = load_id or ids[-1]
    if lid not in ids:
        raise UnknownLoadError(f"unknown load {lid}; available: {', '.join(ids)}")
    return spark.read.parquet(load_folder(spark, bronze_root, source, lid))


def read_loads(spark: SparkSession, bronze_root: str, source: str, load_ids: Sequence[str] | None = None) -> DataFrame:
    """Several loads of a source (default: all; retention bounds them) with their ``load_id``."""
    ids = list_load_ids(spark, bronze_root, source) if load_ids is None else load_ids
    if not ids:
        raise UnknownLoadError(f"no loads for {source}")
    parts = [read_load(spark, bronze_root, source, lid).withColumn("load_id", F.lit(lid)) for lid in ids]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# ------------------------------------------------------------------ A11
#: What stands for NULL in an exported file.
CSV_NULL = "\\N"


def export_csv(tables: dict[str, DataFrame], out_root: str, compression: str = "gzip") -> list[dict]:
    """Bulk export of every table as CSV with header (one folder per table), compressed; readers tell that by the files' names."""
    out = []
    for name, df in tables.items():
        obs = Observation()
        (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True)
         .option("nullValue", CSV_NULL).option("emptyValue", "").option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{out_root}/{name}"))
        out.append({"table": name, "rows": int(obs.get["rows"])})
    return out
