"""The exported CSV files."""

from pyspark.sql import functions as F

from orderlake.sources import bronze as A


def test_exported_files_are_compressed_and_whole(spark, tmpdir_spark):
    """the CSV files of a lake took several times the room of its tables."""
    from orderlake.sources.landing import names_in
    df = spark.range(1000).select(F.col("id").cast("string").alias("a"), F.when(F.col("id") % 2 == 0, F.lit(" x, \"y\"\n")).alias("b"))
    assert A.export_csv({"t": df}, tmpdir_spark) == [{"table": "t", "rows": 1000}]
    files = [n for n in names_in(spark, f"{tmpdir_spark}/t") if n.startswith("part-")]
    assert files and all(n.endswith(".csv.gz") for n in files)
    back = spark.read.schema(df.schema).options(header=True, multiLine=True, escape="\\", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                                                emptyValue="", nullValue=A.CSV_NULL).csv(f"{tmpdir_spark}/t")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
