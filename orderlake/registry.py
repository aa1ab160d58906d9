"""Registry of the named queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import oracle
from orderlake.contract import FIXTURE_CONTRACT as CONTRACT
from orderlake.contract import TOLERANT_CONTRACT
from orderlake.operators import checks as B
from orderlake.operators import gold as G
from orderlake.operators import profile as P
from orderlake.operators import questions as Q
from orderlake.operators import rules as E
from orderlake.operators import silver as S
from orderlake.sources import fixtures as FX
from orderlake.sources.landing import materialized

FLAGSHIP = "carrier_performance"

QueryFn = Callable[[SparkSession, str], DataFrame]


FIXTURE_TABLES = ("orders", "customer", "nation", "lineitem", "part")


def _inputs(d: str) -> list[str]:
    return [f"{d}/{t}.parquet" for t in FIXTURE_TABLES]


def bronze_sales(spark: SparkSession, d: str) -> DataFrame:
    """The fixture's sales source, landed once as Parquet (Bronze)."""
    return materialized(spark, "bronze_sales_raw", _inputs(d), lambda: FX.sales_raw(spark, d))


def bronze_events(spark: SparkSession, d: str) -> DataFrame:
    return materialized(spark, "bronze_events_raw", _inputs(d), lambda: FX.events_raw(spark, d))


def _sales(fn):
    return lambda spark, d: fn(bronze_sales(spark, d))


def _events(fn):
    return lambda spark, d: fn(bronze_events(spark, d))


def _both(fn):
    return lambda spark, d: fn(bronze_sales(spark, d), bronze_events(spark, d))


def f_queries() -> dict[str, QueryFn]:
    return {
        "q01_net_by_channel": _sales(Q.net_by_channel),
        "q02_city_category": _sales(lambda s: Q.city_category(s, oracle.CITY_F2)),
        "q03_recurrence_distribution": _sales(Q.recurrence_distribution),
        "q03_recurrence_kpis": _sales(Q.recurrence_kpis),
        "q04_discount_share": _sales(Q.discount_share),
        "q05_stage_hours_by_carrier": _events(Q.stage_hours_by_carrier),
        "q06_top_products": _sales(Q.top_products),
        "q07_cost_by_city": _both(Q.cost_by_city),
        "q07_cost_by_category": _both(Q.cost_by_category),
        "q07_cost_corr": _both(Q.cost_correlations),
        "q08_incident_rate": _events(Q.incident_rate),
        "q09_payment_channel": _sales(Q.payment_channel),
        "q09_exclusive_methods": _sales(lambda s: Q.exclusive_methods(s, "BUILDING")),
        "q10_avg_net_by_city": _sales(Q.avg_net_by_city),
        "concentration_top3": _sales(Q.concentration_top3),
        "rating_high_share": _sales(Q.rating_high_share),
        "best_month": _sales(Q.best_month),
        "channel_transaction_share": _sales(Q.channel_transaction_share),
        "category_value_vs_transactions": _sales(Q.category_value_vs_transactions),
        "net_skew": _sales(Q.net_skew),
    }


class _Lazy(dict):
    """Dict of named DataFrames built on first access (a query builds only what it reads)."""

    def __init__(self, builders):
        super().__init__()
        self._b = builders

    def __missing__(self, k):
        v = self._b[k](self)
        self[k] = v
        return v


def silver_parts(spark: SparkSession, d: str) -> _Lazy:
    """The Silver artefacts of the fixture binding.

    The row-rule frames (sales and recovered events with their reasons) are
    written once and re-read, so every Silver/Gold query scans them instead of
    recomputing Bronze -> Silver.
    """
    inputs = _inputs(d)
    cols = list(S.SILVER_EVENT_COLS)

    def build_events(p):
        typed = S.prepared_parts(p["e_prep"], CONTRACT)["typed"]
        return S.flag_events(S.recover_and_fill(typed, CONTRACT, valid_sales=p["s_clean"]), p["s_clean"], CONTRACT, p["coverage"])

    def prep_incidents(p):
        prep = S.prepared_parts(p["e_prep"], CONTRACT)
        return prep["dup_inc"].unionByName(prep["res_inc"]).unionByName(prep["conf_inc"])

    b = {
        "sales_raw": lambda p: bronze_sales(spark, d),
        "events_raw": lambda p: bronze_events(spark, d),
        "coverage": lambda p: FX.coverage(spark, d),
        "s_flagged": lambda p: materialized(spark, "silver_sales_flagged", inputs,
                                            lambda: S.flag_sales(p["sales_raw"], CONTRACT, p["coverage"])),
        "s_clean": lambda p: S.split_quarantine(p["s_flagged"])[0],
        "s_rej": lambda p: S.split_quarantine(p["s_flagged"])[1],
        "s_inc": lambda p: S.rejected_incidents(p["s_rej"], S.SRC_SALES, S.LVL_SALE, "sale_id"),
        "e_rec": lambda p: materialized(spark, "silver_events_flagged", inputs, lambda: build_events(p)),
        "e_prep": lambda p: materialized(spark, "silver_events_prepared", inputs,
                                         lambda: S.prepared_events(p["events_raw"])),
        "prep_inc": prep_incidents,
        "e_clean": lambda p: p["e_rec"].where(F.col("reject_reason") == "").select(*cols),
        "e_rej": lambda p: p["e_rec"].where(F.col("reject_reason") != "").select(*cols, "reject_reason"),
        "e_inc": lambda p: (p["prep_inc"].unionByName(S.event_level_incidents(p["e_rec"]))
                            .unionByName(S.rejected_incidents(p["e_rej"], S.SRC_EVENTS, S.LVL_EVENT, "event_id"))
                            .unionByName(S.order_level_incidents(p["e_clean"], CONTRACT))),
        "incidents": lambda p: p["s_inc"].unionByName(p["e_inc"]),
        "g_orders": lambda p: materialized(spark, "gold_orders", inputs,
                                           lambda: G.gold_orders(p["s_clean"], p["e_clean"], CONTRACT)),
    }
    return _Lazy(b)


def _sv(fn):
    return lambda spark, d: fn(silver_parts(spark, d))


def _sales_typed(spark, d):
    df = S.dedup_exact(bronze_sales(spark, d))
    df = S.coerce_rating(df).drop("_rating_fractional")
    return S.normalize_text(df, S.SALES_TEXT_COLS)


def c_queries() -> dict[str, QueryFn]:
    def reason_counts(p):
        s = p["s_rej"].groupBy(F.lit("ventas").alias("source"), "reject_reason").agg(F.count(F.lit(1)).alias("rows"))
        e = p["e_rej"].groupBy(F.lit("logistica").alias("source"), "reject_reason").agg(
            F.count(F.lit(1)).alias("rows"))
        return s.unionByName(e)

    def prep(spark, d):
        return S.prepare_events(bronze_events(spark, d), CONTRACT)

    return {
        "recovery_outcomes": _sv(lambda p: S.recovery_outcomes(p["e_rec"])),
        "dedup_exact": _events(S.dedup_exact),
        "incidents_duplicates": _events(S.duplicate_row_incidents),
        "drop_residual": lambda spark, d: S.drop_residual(S.dedup_exact(bronze_events(spark, d)))[1],
        "resolve_key_conflicts": lambda spark, d: S.resolve_key_conflicts(
            S.drop_residual(S.dedup_exact(bronze_events(spark, d)))[0])[0],
        "coerce_dates": lambda spark, d: prep(spark, d)["typed"].select("event_id", "event_ts", "promised_ts"),
        "coerce_rating": lambda spark, d: _sales_typed(spark, d).select("sale_id", "order_id", "pay_method",
                                                                         "rating"),
        "normalize_text": lambda spark, d: _sales_typed(spark, d).select(
            "sale_id", "pay_method", "city", "channel", "category", "product", "store_id"),
        "recover_group_constant": _sv(lambda p: p["e_rec"].select("event_id", "order_id", "center", "dest_city",
                                                                  "promised_ts")),
        "fill_in_transport_states": _sv(lambda p: p["e_rec"].select("event_id", "state", "carrier", "tracking_no")),
        "explicit_null_category": _sv(lambda p: p["e_rec"].select("event_id", "incident", "note")),
        "silver_sales": _sv(lambda p: p["s_clean"]),
        "quarantine_sales": _sv(lambda p: p["s_rej"]),
        "quarantine_reason_counts": _sv(reason_counts),
        "silver_events": _sv(lambda p: p["e_clean"]),
        "quarantine_events": _sv(lambda p: p["e_rej"]),
        "incident_log": _sv(lambda p: p["incidents"]),
        "missing_states": _sv(lambda p: S.order_level_incidents(p["e_clean"], CONTRACT)
                              .where(F.col("kind") == "Trazabilidad incompleta")),
        "delivered_without_date": _sv(lambda p: S.order_level_incidents(p["e_clean"], CONTRACT)
                                      .where(F.col("kind") == "Evento Entregado sin fecha")),
        "shared_tracking_orders": _sv(lambda p: S.shared_tracking_pairs(p["e_clean"])),
        "incident_summary": _sv(lambda p: S.incident_summary(p["incidents"])),
    }


gold_parts = silver_parts


def _gd(fn):
    return lambda spark, d: fn(gold_parts(spark, d))


def d_queries() -> dict[str, QueryFn]:
    return {
        "gold_events": _sv(lambda p: G.gold_events(p["s_clean"], p["e_clean"])),
        "order_summary": _sv(lambda p: G.order_summary(p["e_clean"], CONTRACT).drop("has_delivered")),
        "order_flags": _sv(lambda p: G.order_flags(G.order_summary(p["e_clean"], CONTRACT), p["e_clean"])
                           .select("order_id", "tracking_no", "n_states", "trace_complete", "tracking_shared")),
        "gold_orders": _gd(lambda p: p["g_orders"]),
        "delivery_delay": _gd(lambda p: p["g_orders"].select("order_id", "promised_ts", "delivery_ts",
                                                              "delay_days", "late")),
        "delivery_indicators": _gd(lambda p: p["g_orders"].select("order_id", "delivered", "delivery_ts")),
        "cycle_days": _gd(lambda p: p["g_orders"].select("order_id", "cycle_days", "promised_days", "month")),
        "kpi_monthly": _gd(lambda p: G.kpi_monthly(p["g_orders"])),
        "carrier_performance": _gd(lambda p: G.carrier_performance(p["g_orders"])),
        "city_channel_sales": _gd(lambda p: G.city_channel_sales(p["g_orders"])),
        "delivery_kpis": _gd(lambda p: G.delivery_kpis(p["g_orders"], p["e_clean"], CONTRACT)),
        "late_rate_by_month": _gd(lambda p: G.late_rate_by_month(p["g_orders"])),
        "delay_distribution": _gd(lambda p: G.delay_distribution(p["g_orders"])),
    }


def _count(df: DataFrame):
    return df.agg(F.count(F.lit(1))).scalar()


def _marts(p) -> dict[str, DataFrame]:
    return {"kpi_monthly": G.kpi_monthly(p["g_orders"]),
            "carrier_performance": G.carrier_performance(p["g_orders"]),
            "city_channel_sales": G.city_channel_sales(p["g_orders"])}


def e_queries() -> dict[str, QueryFn]:
    def silver_rules(p):
        return E.silver_rules(p["s_clean"], p["e_clean"], CONTRACT, _count(p["sales_raw"]), _count(p["s_rej"]),
                              _count(p["events_raw"]), _count(p["e_rej"]), p["coverage"])

    def gold_rules(p, contract=None):
        return E.gold_rules(p["s_clean"], p["e_clean"], G.gold_events(p["s_clean"], p["e_clean"]),
                            p["g_orders"], _marts(p), contract)

    def details(p):
        offenders = E.silver_offenders(p["s_clean"], p["e_clean"], CONTRACT, p["coverage"]).unionByName(
            E.gold_offenders(G.gold_events(p["s_clean"], p["e_clean"]), p["g_orders"]))
        return E.rule_details(silver_rules(p).unionByName(gold_rules(p)), offenders)

    def share(p):
        return E.quarantine_share(_count(p["sales_raw"]), _count(p["s_rej"]), _count(p["events_raw"]),
                                  _count(p["e_rej"]), p["sales_raw"].agg(F.count(F.lit(1))), CONTRACT)
    return {
        "silver_rules": _sv(silver_rules),
        "gold_rules": _gd(gold_rules),
        "reconcile_marts": _gd(lambda p: gold_rules(p).where(F.col("rule").contains("reconcile"))),
        "gold_rules_expected_gaps": _gd(lambda p: gold_rules(p, TOLERANT_CONTRACT)),
        "rule_details": _gd(details),
        "quarantine_share": _sv(share),
    }


def b_queries() -> dict[str, QueryFn]:
    def both(fn):
        return lambda spark, d: fn(bronze_sales(spark, d), "sales").unionByName(fn(bronze_events(spark, d), "events"))

    def first_ship_cost(e):
        return P.once_per_order(e, "ship_cost")

    def accented(s):
        """Every fifth city written with accents, every seventh in small letters."""
        return s.withColumn("city", F.when(F.col("sale_id") % 5 == 0, F.translate("city", "AEIOU", "ÁÉÍÓÚ"))
                            .when(F.col("sale_id") % 7 == 0, F.lower("city")).otherwise(F.col("city")))

    std_cols = {"sales": ("city", "channel", "category", "product", "pay_method"),
                "events": ("state", "center", "dest_city", "carrier", "incident", "note")}
    return {
        "profile_date_range": both(P.date_range),
        "profile_structure": both(P.structure),
        "profile_nulls": lambda spark, d: both(P.structure)(spark, d).select("tbl", "column", "nulls", "pct_null"),
        "profile_cardinality": both(P.cardinality),
        "profile_numeric_summary": both(P.numeric_summary),
        "profile_once_per_order": _events(first_ship_cost),
        "profile_categorical_summary": both(P.categorical_summary),
        "profile_categorical_values": both(P.categorical_values),
        "freq_channel": _sales(lambda s: P.frequency(s, "channel")),
        "freq_state": _events(lambda e: P.frequency(e, "state")),
        "freq_quantity": _sales(lambda s: P.frequency(s, "quantity")),
        "profile_conditional_nulls": _both(lambda s, e: P.conditional_nulls(s, e, CONTRACT.physical_channel,
                                                                            CONTRACT.transport_states)),
        "profile_nulls_by_state": _events(P.nulls_by_state),
        "check_amount_identities": _sales(B.amount_identities),
        "check_negatives": _both(B.negatives),
        "check_referential": _both(B.referential),
        "check_city_mismatch": _both(B.city_mismatch),
        "check_events_per_order": _events(B.events_per_order),
        "check_incomplete_trace": _events(B.incomplete_trace),
        "check_constant_in_group": _events(B.constant_in_group),
        "check_shared_tracking": _events(B.shared_tracking),
        "check_unparseable_dates": _events(B.unparseable_dates),
        "check_residual_columns": _events(B.residual_columns),
        "check_residual_values": _events(B.residual_values),
        "check_event_before_sale": _both(B.event_before_sale),
        "check_promise_before_sale": _both(B.promise_before_sale),
        "check_out_of_order": _events(B.out_of_order),
        "first_state_distribution": _events(B.first_state_distribution),
        "standardize_impact": lambda spark, d: P.standardize_impact(bronze_sales(spark, d), "sales",
                                                                    std_cols["sales"]).unionByName(
            P.standardize_impact(bronze_events(spark, d), "events", std_cols["events"])),
        "standardize_impact_accents": _sales(lambda s: P.standardize_impact(accented(s), "sales", ("city", "channel"), fold_accents=True)),
        "conflict_diff_columns": _events(P.conflict_diff_columns),
        "histogram_net": _sales(lambda s: P.histogram(s, "net", 20)),
        "histogram_unit_price": _sales(lambda s: P.histogram(s, "unit_price", 20)),
        "freq_rating": _sales(lambda s: P.frequency(s, "rating")),
        "boxplot_stage_hours": _events(lambda e: P.boxplot(e, "stage_hours")),
        "null_before_after": _sv(lambda p: P.null_before_after(
            p["events_raw"], p["e_clean"], "events", {"event_ts_txt": "event_ts", "promised_ts_txt": "promised_ts"}).unionByName(
            P.null_before_after(p["sales_raw"], p["s_clean"], "sales"))),
        "profile_null_findings": both(P.null_findings),
        "check_conditional_presence": _sales(lambda s: P.conditional_presence(s, CONTRACT.physical_channel)),
        "profile_duplicates": _both(P.duplicates),
        "profile_type_check": both(P.type_check),
    }


LOAD_FIRST, LOAD_STRICT = oracle.LOAD_FIRST, oracle.LOAD_STRICT


def scenario_lake(spark: SparkSession, d: str):
    """A lake holding a fixed, deterministic history of the whole binding (built once per input fingerprint, beside
    its place, and renamed when whole):
    1) a load landed and published under the tolerant contract, 2) the same load reprocessed,
    3) the same sources landed as a second load under the strict contract, failing the Silver gate."""
    from orderlake.plans import pipeline as PL
    from orderlake.sources.landing import built_once, fingerprint_paths
    sources = {"sales": bronze_sales(spark, d), "events": bronze_events(spark, d)}

    def build(root: str) -> None:
        lake, cov = PL.Lake(root), FX.coverage(spark, d)
        PL.run_pipeline(spark, lake, sources, TOLERANT_CONTRACT, cov, load_id=LOAD_FIRST)
        PL.reprocess(spark, lake, TOLERANT_CONTRACT, cov, load_id=LOAD_FIRST)
        try:
            PL.run_pipeline(spark, lake, sources, CONTRACT, cov, load_id=LOAD_STRICT)
        except E.GateError:
            pass
    lake = PL.Lake.in_checkpoint_dir(spark, f"orderlake-lake-{fingerprint_paths(spark, _inputs(d), CONTRACT, TOLERANT_CONTRACT)}")
    built_once(spark, lake.root, build)
    return lake


def _runs(spark, lake):
    from orderlake.plans import ledger as L
    return L.read(spark, lake.ledger, "run").orderBy("started_at", "run_id").collect()


def ag_queries() -> dict[str, QueryFn]:
    from orderlake.plans import ledger as L
    from orderlake.plans import pipeline as PL
    from orderlake.sources import bronze as A

    def pipeline_run(spark, d):
        lake = scenario_lake(spark, d)
        return PL.published(spark, lake, "gold", "orders").drop("run_id")

    def lineage(spark, d):
        lake = scenario_lake(spark, d)
        return PL.published(spark, lake, "silver", "events").select("event_id", "order_id", "load_id")

    def run_ledger(spark, d):
        lake = scenario_lake(spark, d)
        first = _runs(spark, lake)[0]["run_id"]
        return (L.read(spark, lake.ledger, "run_table").where(F.col("run_id") == first)
                .select("layer", "table", "rows", "columns"))

    def reprocess_load(spark, d):
        """Same load reprocessed -> same content: order-insensitive fingerprints per table."""
        lake = scenario_lake(spark, d)
        r1, r2 = [r["run_id"] for r in _runs(spark, lake)[:2]]
        out = None
        for layer, table in (("silver", "sales"), ("silver", "events"), ("gold", "orders"), ("gold", "events"),
                             ("gold", "kpi_monthly"), ("gold", "carrier_performance"),
                             ("gold", "city_channel_sales")):
            fps = []
            for rid in (r1, r2):
                run = lake.run_dir(rid)
                df = PL.silver_part(spark, run, table) if layer == "silver" else spark.read.parquet(f"{run}/{layer}/{table}")
                df = df.drop("run_id", "load_id")
                fps.append(df.agg(*A.content_fingerprint_expr(df.columns)))
            a, b = fps
            one = a.select(F.lit(layer).alias("layer"), F.lit(table).alias("table"), F.col("rows"),
                           (F.col("hash_sum") == b.select("hash_sum").scalar()).alias("same_content"))
            out = one if out is None else out.unionByName(one)
        return out

    def run_history(spark, d):
        lake = scenario_lake(spark, d)
        return L.run_history(spark, lake.ledger).select("seq", "load_id", "origin", "status", "rules_passed",
                                                         "rules_total", "on_newest_load")

    def bronze_land(spark, d):
        lake = scenario_lake(spark, d)
        return A.read_loads(spark, lake.bronze, "sales", [LOAD_STRICT])

    def bronze_read_load(spark, d):
        return A.read_load(spark, scenario_lake(spark, d).bronze, "events", LOAD_FIRST)

    def _per_load(spark, lake):
        s = A.read_loads(spark, lake.bronze, "sales").groupBy("load_id").agg(F.count(F.lit(1)).alias("sales_rows"))
        e = A.read_loads(spark, lake.bronze, "events").groupBy("load_id").agg(F.count(F.lit(1)).alias("events_rows"))
        return s.join(e, "load_id", "full")

    def bronze_list_loads(spark, d):
        lake = scenario_lake(spark, d)
        return _per_load(spark, lake).join(A.list_loads(spark, lake.bronze, "sales"), "load_id")

    def bronze_retention(spark, d):
        lake = scenario_lake(spark, d)
        plan = A.retention_plan(A.list_loads(spark, lake.bronze, "sales"), 1)
        return (plan.join(_per_load(spark, lake).select("load_id", "sales_rows"), "load_id")
                .select("load_id", "sales_rows", "rank", "drop"))

    def write_layer_counts(spark, d):
        lake = scenario_lake(spark, d)
        first = _runs(spark, lake)[0]["run_id"]
        return (L.read(spark, lake.ledger, "run_source").where(F.col("run_id") == first)
                .select("source", "rows", "columns"))

    def land_events_text(spark, d):
        ev = bronze_events(spark, d)
        return A.read_text_table(spark, _events_csv(spark, ev, d), ev.schema)

    def export_tables(spark, d):
        """Every published table and the landed sources as CSV; per table the rows and the sum of the
        rows' hash numbers (over all columns as text), read back from the files."""
        lake = scenario_lake(spark, d)
        out = f"{lake.root}/export"
        tables = {f"{layer}.{t}": PL.published(spark, lake, layer, t).drop("run_id", "load_id")
                  for layer, t in oracle.PUBLISHED}
        tables |= {f"bronze.{s}": A.read_load(spark, lake.bronze, s, LOAD_FIRST) for s in ("sales", "events")}
        texts = {n: df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]) for n, df in tables.items()}
        A.export_csv(texts, out)
        res = None
        for n, df in texts.items():
            back = spark.read.schema(df.schema).option("header", True).option("ignoreLeadingWhiteSpace", False).option(
                "ignoreTrailingWhiteSpace", False).option("emptyValue", "").option("nullValue", A.CSV_NULL).csv(f"{out}/{n}")
            key = oracle.EXPORT_KEYS[n]
            one = back.agg(F.count(F.lit(1)).alias("rows"), *[
                F.sum(F.length(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in key]))).alias("chars")]).select(
                F.lit(n).alias("table"), "rows", "chars")
            res = one if res is None else res.unionByName(one)
        return res

    def profile_loads(source):
        """The profile of all loads from their stored sketches, held against the loads themselves."""
        def query(spark, d):
            from orderlake.operators import sketches as K
            lake = scenario_lake(spark, d)
            return K.within_errors(A.read_loads(spark, lake.bronze, source).drop("load_id"), K.profile_loads(spark, lake.bronze, source))
        return query

    return {
        "profile_loads_sales": profile_loads("sales"), "profile_loads_events": profile_loads("events"),
        "pipeline_run": pipeline_run, "lineage_stamp": lineage, "run_ledger": run_ledger,
        "reprocess_load": reprocess_load, "run_history": run_history, "bronze_land": bronze_land,
        "bronze_read_load": bronze_read_load, "bronze_list_loads": bronze_list_loads,
        "bronze_retention": bronze_retention, "write_layer_counts": write_layer_counts,
        "source_fingerprint": _sales(lambda s: A.row_sha256(s)),
        "extraction_probe": _both(lambda s, e: A.extraction_probe(s, "sales").unionByName(
            A.extraction_probe(e, "events"))),
        "extraction_columns": _both(lambda s, e: A.extraction_columns(s, "sales").unionByName(A.extraction_columns(e, "events"))),
        "extraction_head": _sales(lambda s: A.extraction_head(s, ["sale_id"])),
        "extraction_sample": _sales(lambda s: A.repeatable_sample(s, ["sale_id"])),
        "extraction_sample_events": _events(lambda e: A.repeatable_sample(e, ["event_id"])),
        "land_events_text": land_events_text, "export_tables": export_tables,
    }


def _events_csv(spark, ev, d):
    """The events as a CSV folder, written once per input fingerprint."""
    from orderlake.session import ensure_checkpoint_dir
    from orderlake.sources import bronze as A
    from orderlake.sources.landing import built_once, fingerprint_paths
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/orderlake-csv-{fingerprint_paths(spark, _inputs(d))}"
    return built_once(spark, path, lambda made: A.write_text_table(ev, made))


def g6_queries() -> dict[str, QueryFn]:
    def stream_landing(spark, d):
        """The driver's ``events`` table split by ``event_id`` range into 4 files,
        replayed with availableNow (one file per micro-batch): the landed Bronze
        must equal the table (stream = batch parity)."""
        import uuid

        from orderlake.session import ensure_checkpoint_dir
        from orderlake.streaming.incremental import land_new_files
        src_tbl = FX.read_table(spark, d, "events")
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/orderlake-stream-{uuid.uuid4().hex[:8]}"
        (src_tbl.repartitionByRange(4, "event_id").write.mode("overwrite").parquet(f"{root}/incoming"))
        land_new_files(spark, f"{root}/incoming", src_tbl.schema, f"{root}/bronze", f"{root}/_checkpoint",
                       max_files_per_batch=1)
        return spark.read.parquet(f"{root}/bronze").drop("load_id")

    def merged(layer, table):
        """A table of the publication that three increments were merged into."""
        from orderlake.plans import pipeline as PL
        return lambda spark, d: PL.published(spark, increments_lake(spark, d), layer, table).drop("run_id", "load_id")
    return {"stream_landing": stream_landing, "stream_publish": merged("gold", "orders"),
            "stream_publish_events": merged("silver", "events"), "stream_publish_incidents": merged("silver", "incidents"),
            "stream_publish_city_channel": merged("gold", "city_channel_sales")}


def increments_lake(spark: SparkSession, d: str):
    """A lake into which the events of the whole binding came as a stream of three files, each merged into the publication."""
    from orderlake.contract import INCREMENT_CONTRACT
    from orderlake.plans import pipeline as PL
    from orderlake.sources.landing import built_once, fingerprint_paths
    from orderlake.streaming.incremental import publish_new_files
    events = bronze_events(spark, d)

    def build(root: str) -> None:
        for at in (1, 2, 3):
            came = events.where(F.expr(oracle.INCREMENT) == at).repartitionByRange("event_id").sortWithinPartitions("event_id", *events.columns)
            came.write.parquet(f"{root}/incoming/increment={at}")
            done = publish_new_files(spark, PL.Lake(root), f"{root}/incoming/*", events.schema, lambda: bronze_sales(spark, d),
                                     INCREMENT_CONTRACT, FX.coverage(spark, d), f"{root}/stream")
            if [status for _, status in done] != ["PUBLISHED"]:
                raise RuntimeError(f"increment {at}: {done}")
    lake = PL.Lake.in_checkpoint_dir(spark, f"orderlake-increments-{fingerprint_paths(spark, _inputs(d), INCREMENT_CONTRACT)}")
    built_once(spark, lake.root, build)
    return lake


def arrival_queries() -> dict[str, QueryFn]:
    """First by arrival (C1, C4, C12), where it decides otherwise than the order of all columns would."""
    from orderlake.sources import bronze as A
    from orderlake.sources.landing import built_once, fingerprint_paths
    from orderlake.session import ensure_checkpoint_dir

    def delivered(spark, d, name, deliveries, key):
        """Deliveries written one after the other, each sorted by key and then by all columns backwards, landed with their arrival."""
        def build(root):
            for at, df in enumerate(deliveries):
                down = [F.col(c).desc_nulls_last() for c in df.columns]
                df.repartitionByRange(key).sortWithinPartitions(key, *down).write.parquet(f"{root}/delivery={at}")
            files = [f"{root}/delivery={at}" for at in range(len(deliveries))]
            A.land_load(spark, f"{root}/bronze", {name: A.with_arrival(spark.read.schema(deliveries[0].schema).parquet(*files))}, LOAD_FIRST)
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/orderlake-arrival-{name}-{fingerprint_paths(spark, _inputs(d))}"
        return A.read_load(spark, f"{built_once(spark, path, build)}/bronze", name, LOAD_FIRST)

    def arrival_events(spark, d):
        """Every third event came first with another note, then as it is."""
        events = bronze_events(spark, d)
        early = events.where("event_id % 3 = 0").withColumn("note", F.lit("zz early"))
        rows = S.prepared_events(delivered(spark, d, "events", [early.distinct(), events], "event_id"))
        return rows.select("event_id", "order_id", "note", F.col("_n").alias("copies"), F.col("_win").alias("kept"))

    def arrival_sales(spark, d):
        """The repeated sales came before the others."""
        sales = bronze_sales(spark, d)
        again = F.coalesce(F.col("pay_method") == "ZZ-DUP", F.lit(False))
        landed = delivered(spark, d, "sales", [sales.where(again), sales.where(~again)], "sale_id")
        return S.flag_sales(landed, CONTRACT, FX.coverage(spark, d)).select("sale_id", "pay_method", "net", "reject_reason")
    return {"arrival_events": arrival_events, "arrival_sales": arrival_sales}


def all_queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    out.update(f_queries())
    out.update(c_queries())
    out.update(d_queries())
    out.update(e_queries())
    out.update(b_queries())
    out.update(ag_queries())
    out.update(g6_queries())
    out.update(arrival_queries())
    return out


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(oracle.f_queries())
    out.update(oracle.c_queries())
    out.update(oracle.d_queries())
    out.update(oracle.e_queries())
    out.update(oracle.b_queries())
    out.update(oracle.b_extra_queries())
    out.update(oracle.ag_queries())
    out.update(oracle.stream_queries())
    out.update(oracle.arrival_queries())
    return out
