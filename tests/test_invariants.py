"""Conservation and reconciliation invariants."""

from pyspark.sql import functions as F

from given_tables import SF_SMALL
from orderlake import registry as R


def test_no_sale_is_lost(spark):
    p = R.silver_parts(spark, SF_SMALL)
    deduped = p["sales_raw"].dropDuplicates().count()
    assert p["s_clean"].count() + p["s_rej"].count() == deduped


def test_no_event_is_lost(spark):
    p = R.silver_parts(spark, SF_SMALL)
    raw = p["events_raw"]
    kept_keys = raw.select("event_id").distinct().count()
    assert p["e_clean"].count() + p["e_rej"].count() == kept_keys
    removed = raw.count() - kept_keys
    inc = p["incidents"]
    logged = inc.where(F.col("kind").isin("Fila duplicada", "evento_id repetido con contenido distinto")).count()
    assert logged == removed


def test_every_rejected_row_has_an_incident(spark):
    p = R.silver_parts(spark, SF_SMALL)
    rej = p["s_rej"].count() + p["e_rej"].count()
    assert p["incidents"].where(F.col("kind") == "Registro rechazado").count() == rej


def test_gold_reconciles_with_silver(spark):
    p = R.gold_parts(spark, SF_SMALL)
    g = p["g_orders"]
    assert g.count() == p["s_clean"].count()
    assert g.agg(F.sum("net")).first()[0] == p["s_clean"].agg(F.sum("net")).first()[0]
    from orderlake.operators import gold as G
    assert G.city_channel_sales(g).agg(F.sum("orders")).first()[0] == g.where(
        F.col("city").isNotNull() & F.col("channel").isNotNull()).count()


def test_whole_binding_publishes_every_valid_sale(spark):
    lake = R.scenario_lake(spark, SF_SMALL)
    from orderlake.plans import ledger as L
    hist = {r["seq"]: r for r in L.run_history(spark, lake.ledger).collect()}
    assert hist[1]["status"] == "PUBLISHED" and hist[1]["rules_passed"] == 33
    assert hist[2]["origin"] == "reprocess" and hist[2]["status"] == "PUBLISHED"
    assert hist[3]["status"] == "FAILED"
    from orderlake.plans import pipeline as PL
    parts = R.silver_parts(spark, SF_SMALL)
    assert PL.published(spark, lake, "gold", "orders").count() == parts["s_clean"].count()
    assert parts["sales_raw"].select("order_id").distinct().count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
