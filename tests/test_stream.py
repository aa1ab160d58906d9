"""Incremental landing: k files through availableNow = one batch; a rerun lands nothing new."""

import tempfile

import pytest
from pyspark.sql import functions as F

from given_tables import SF_SMALL
from orderlake import registry as R
from orderlake.contract import INCREMENT_CONTRACT
from orderlake.operators import silver as S
from orderlake.plans import increment as I
from orderlake.plans import ledger as L
from orderlake.plans.pipeline import Lake, published, run_pipeline
from orderlake.sources import bronze as A
from orderlake.sources import fixtures as FX
from orderlake.sources.fixtures import read_table
from orderlake.streaming.incremental import land_new_files, publish_new_files


def test_stream_equals_batch_and_is_incremental(spark):
    root = tempfile.mkdtemp(prefix="orderlake-stream-", dir="/tmp")
    src = read_table(spark, SF_SMALL, "events")
    src.repartitionByRange(3, "event_id").write.parquet(f"{root}/in")
    ids = land_new_files(spark, f"{root}/in", src.schema, f"{root}/bronze", f"{root}/ck", max_files_per_batch=1)
    assert len(ids) == 3
    landed = spark.read.parquet(f"{root}/bronze").drop("load_id")
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, src.collect()))
    assert land_new_files(spark, f"{root}/in", src.schema, f"{root}/bronze", f"{root}/ck") == []


def _by_content(df):
    return sorted(repr(tuple(r)) for r in df.drop("run_id", "load_id").select(*sorted(c for c in df.columns if c not in ("run_id", "load_id"))).collect())


PUBLISHED = [("silver", "sales"), ("silver", "sales_rejected"), ("silver", "events"), ("silver", "events_rejected"), ("silver", "incidents"), ("gold", "orders"),
             ("gold", "events"), ("gold", "kpi_monthly"), ("gold", "carrier_performance"), ("gold", "city_channel_sales")]


def test_increments_publish_what_one_batch_does(spark, tmpdir_spark):
    """Late events, copies and versions of earlier events (also under another order), a failing file and a replay."""
    events, cov = R.bronze_events(spark, SF_SMALL), FX.coverage(spark, SF_SMALL)
    sales = R.bronze_sales(spark, SF_SMALL)
    lake, drop = Lake(f"{tmpdir_spark}/lake"), f"{tmpdir_spark}/drop"
    part = F.expr("CASE WHEN event_id % 7 = 2 THEN 2 ELSE order_id % 3 END")
    first = events.where(part == 0)
    other_order = first.where("event_id % 11 = 3").withColumn("order_id", F.col("order_id") + 1).withColumn("note", F.lit("moved"))
    second = events.where(part == 1).unionByName(first.where("event_id % 13 = 1")).unionByName(other_order)
    orphans = events.withColumns({c: F.col(c) + 10**12 for c in ("event_id", "order_id")})  # no sale: beyond the admitted share
    third = events.where(part == 2).unionByName(second.where("event_id % 17 = 5").withColumn("center", F.lit(None).cast("string")))
    sold = {"now": sales.where("sale_id % 50 <> 0")}

    def run():
        return publish_new_files(spark, lake, drop, events.schema, lambda: sold["now"], INCREMENT_CONTRACT, cov, f"{tmpdir_spark}/checkpoint")
    statuses = []
    for rows, snapshot in ((first, sold["now"]), (second, sold["now"]), (orphans, sold["now"]), (third, sales)):
        sold["now"] = snapshot
        rows.coalesce(1).write.mode("append").parquet(drop)
        before = L.published_run(spark, lake.ledger)
        statuses += run()
        if statuses[-1][1] == "FAILED":
            assert L.published_run(spark, lake.ledger) == before
    assert statuses == [(f"s{i:08d}", s) for i, s in enumerate(["PUBLISHED", "PUBLISHED", "FAILED", "PUBLISHED"])] and run() == []
    inputs = L.read(spark, lake.ledger, "run_input").where(F.col("run_id") == L.published_run(spark, lake.ledger)[0])
    assert {r["load_id"] for r in inputs.where("source = 'events'").collect()} == {"s00000000", "s00000001", "s00000003"}
    # the same files as one load, in the order in which they came
    batch = Lake(f"{tmpdir_spark}/batch")
    came = A.read_loads(spark, lake.bronze, "events", ["s00000000", "s00000001", "s00000003"]).drop("load_id")
    run_pipeline(spark, batch, {"sales": sales, "events": came}, INCREMENT_CONTRACT, cov, load_id="20240101_000000")
    for layer, table in PUBLISHED:
        assert _by_content(published(spark, lake, layer, table)) == _by_content(published(spark, batch, layer, table)), (layer, table)
    # rows of orders that the last increment could not change keep the load that made them
    loads = {r["load_id"] for r in published(spark, lake, "silver", "events").select("load_id").distinct().collect()}
    assert loads == {"s00000000", "s00000001", "s00000003"} or "s00000003" in loads and len(loads) > 1


def test_an_increment_on_a_changed_publication_is_run_again(spark, tmpdir_spark, monkeypatch):
    lake, cov = Lake(tmpdir_spark), FX.coverage(spark, SF_SMALL)
    events, sales = R.bronze_events(spark, SF_SMALL), R.bronze_sales(spark, SF_SMALL)

    def increment(at, load):
        return I.publish_increment(spark, lake, {"sales": sales, "events": events.where(F.col("order_id") % 3 == at)}, INCREMENT_CONTRACT, cov, load)
    assert increment(0, "a").status == "PUBLISHED"
    merge = I.merge

    def slow(*args):  # while "c" is merged, "b" is published
        monkeypatch.setattr(I, "merge", merge)
        result = merge(*args)
        assert increment(1, "b").status == "PUBLISHED"
        return result
    monkeypatch.setattr(I, "merge", slow)
    assert increment(2, "c").status == "SUPERSEDED" and I.published_inputs(spark, lake)[1] == ["a", "b"]
    assert increment(2, "c").status == "PUBLISHED" and I.published_inputs(spark, lake)[1] == ["a", "b", "c"]
    with pytest.raises(A.LoadExistsError):
        increment(2, "c")


def test_arrival_of_text_rows_is_their_order_in_the_files(spark, tmpdir_spark):
    for at in range(2):
        rows = [(k, f"v{at}-{j}") for j, k in enumerate([3, 1, 3, 2, 1])]
        spark.createDataFrame(rows, "k long, v string").coalesce(1).write.mode("append").option("header", True).csv(f"{tmpdir_spark}/in{at}")
    read = spark.read.schema("k long, v string").option("header", True).csv([f"{tmpdir_spark}/in0", f"{tmpdir_spark}/in1"])
    A.land_load(spark, f"{tmpdir_spark}/bronze", {"t": A.with_arrival(read, "csv")}, "l1")
    landed = A.read_load(spark, f"{tmpdir_spark}/bronze", "t", "l1")
    assert S.ARRIVAL in landed.columns and landed.count() == 10
    flagged = S.first_arrival_flags(landed, "k", "again")
    assert sorted((r["k"], r["v"]) for r in flagged.where("not again").collect()) == [(1, "v0-1"), (2, "v0-3"), (3, "v0-0")]
    # a later load without arrival, and one with it, are the same table to readers
    A.land_load(spark, f"{tmpdir_spark}/bronze", {"t": read}, "l2")
    assert A.read_loads(spark, f"{tmpdir_spark}/bronze", "t").count() == 20
