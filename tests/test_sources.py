"""Text sources keep malformed rows with their raw text; samples and fingerprints don't depend on partitioning."""

from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from orderlake.sources import bronze as A

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("at", TimestampType())])


def test_malformed_csv_rows_are_kept(spark, tmpdir_spark):
    with open(f"{tmpdir_spark}/a.csv", "w") as f:
        f.write("id,name,at\n1, padded ,2024-01-01 10:00:00\nnot a number,x,2024-01-01 10:00:00\n3,y,no time\n")
    rows = {r["name"]: r for r in A.read_text_table(spark, tmpdir_spark, SCHEMA).collect()}
    assert rows[" padded "]["id"] == 1 and rows[" padded "]["_corrupt_record"] is None
    assert rows["x"]["id"] is None and rows["x"]["_corrupt_record"] == "not a number,x,2024-01-01 10:00:00"
    assert rows["y"]["at"] is None and rows["y"]["_corrupt_record"].startswith("3,y")


def test_malformed_json_rows_are_kept(spark, tmpdir_spark):
    with open(f"{tmpdir_spark}/a.json", "w") as f:
        f.write('{"id": 1, "name": "a", "at": "2024-01-01T10:00:00"}\n{"id": oops}\n')
    rows = A.read_text_table(spark, tmpdir_spark, SCHEMA, fmt="json").collect()
    assert sorted((r["id"] or 0, r["_corrupt_record"]) for r in rows) == [(0, '{"id": oops}'), (1, None)]


def test_sample_and_fingerprint_do_not_depend_on_partitioning(spark):
    df = spark.range(500).selectExpr("id", "concat('n', id) as name")
    samples = [A.repeatable_sample(d, ["id"], 7).collect() for d in (df, df.repartition(5))]
    assert samples[0] == samples[1] and len(samples[0]) == 7
    prints = [d.agg(*A.content_fingerprint_expr(d.columns)).first() for d in (df, df.repartition(5, "name"))]
    assert prints[0] == prints[1]


def test_file_hashes(spark, tmpdir_spark):
    import hashlib
    with open(f"{tmpdir_spark}/x.bin", "wb") as f:
        f.write(b"abc")
    assert [r["sha256"] for r in A.file_sha256(spark, f"{tmpdir_spark}/*.bin").collect()] == [hashlib.sha256(b"abc").hexdigest()]


def test_large_files_are_hashed_as_streams(spark, tmpdir_spark):
    """Files beyond a cell: any number of buffers, whole and part; names that a URI would need to escape."""
    import hashlib
    files = {"empty": b"", "cell": b"x" * 1000, "over": b"y" * 1001, "buffers": bytes(range(256)) * 64, "odd name #1 %20?": b"z" * 5003}
    for name, content in files.items():
        with open(f"{tmpdir_spark}/{name}", "wb") as f:
            f.write(content)
    for cell, buffer in ((1000, 64), (0, 4096), (1 << 20, 64)):
        rows = A.file_sha256(spark, tmpdir_spark, cell, buffer).collect()
        got = {r["path"].rsplit("/", 1)[-1]: (r["length"], r["sha256"]) for r in rows}
        assert got == {name: (len(content), hashlib.sha256(content).hexdigest()) for name, content in files.items() if content}


def test_content_of_large_files_is_not_read_into_cells(spark, tmpdir_spark):
    """A sparse file beyond what a cell can hold (2 GB) is hashed without reading it whole."""
    import hashlib
    size = (1 << 31) + 5
    with open(f"{tmpdir_spark}/large", "wb") as f:
        f.truncate(size)
    want = hashlib.sha256()
    for _ in range(size // (1 << 20)):
        want.update(bytes(1 << 20))
    want.update(bytes(size % (1 << 20)))
    row = A.file_sha256(spark, tmpdir_spark).collect()[0]
    assert (row["length"], row["sha256"]) == (size, want.hexdigest())


def test_writes_free_their_shuffle_files(spark, tmpdir_spark):
    """A derived table's write, a run and a scratch table leave no shuffle files behind, also nested and from several threads."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import functions as F

    from orderlake.session import FREED_SHUFFLES, freed_shuffles
    from orderlake.sources.landing import built_once, scratch

    def left() -> int:
        kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return sum("shuffle_" in kept.apply(i).name() for i in range(kept.size()))

    def shuffled(n: int):
        return spark.range(2000).withColumn("k", F.col("id") % n).groupBy("k").count()
    before = left()
    path = built_once(spark, f"{tmpdir_spark}/t", lambda made: shuffled(7).write.parquet(made))
    assert len(spark.read.parquet(path).collect()) == 7 and len(scratch(shuffled(11)).collect()) == 11
    spark.conf.set(FREED_SHUFFLES, "false")
    with freed_shuffles(spark), ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: built_once(spark, f"{tmpdir_spark}/u{n}", lambda made: shuffled(n).write.parquet(made)), range(3, 9)))
        assert spark.conf.get(FREED_SHUFFLES) == "true"
    assert spark.conf.get(FREED_SHUFFLES) == "false"
    assert left() <= before
