"""Batch pipeline: land -> Silver -> gate -> Gold -> gate -> publish.

Every layer of a run is written under ``runs/<run_id>/`` and read back from
Parquet before the next step (the lineage is cut at each layer, so a lost
executor only recomputes the current stage). Gold is built only after the Silver
gate has passed. Nothing is visible to readers until the ledger's publication pointer
names the run (S26): a failing gate, or a killed run, leaves the previously published run in
place. Only small metadata (rule table, counts) ever reaches the driver.

A Silver table is written once, partitioned by whether its rows passed the row
rules; the clean and the rejected table are its two partitions.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlake.contract import Contract
from orderlake.operators import gold as G
from orderlake.operators import rules as E
from orderlake.operators import silver as S
from orderlake.plans import ledger as L
from orderlake.sources import bronze as A
from orderlake.sources.landing import path_exists, remove_path
from orderlake.session import ensure_checkpoint_dir, freed_shuffles, unsorted_writes

SOURCES = ("sales", "events")
# Concurrent jobs submitted by one run (independent writes share the executors).
MAX_CONCURRENT_JOBS = 4


@dataclass(frozen=True)
class Lake:
    """Folder layout of one deployment (a shared filesystem path)."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    def run_dir(self, run_id: str) -> str:
        return f"{self.root}/runs/{run_id}"

    @staticmethod
    def in_checkpoint_dir(spark: SparkSession, name: str) -> "Lake":
        return Lake(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}")


@dataclass
class RunResult:
    run_id: str
    load_id: str
    status: str
    rules: list[tuple]
    tables: dict[str, dict]
    timings: dict[str, float] | None = None


def new_load_id() -> str:
    """One-second resolution id (the landing refuses to overwrite an existing one, S31)."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")


def _stamp(df: DataFrame, run_id: str, load_id: str) -> DataFrame:
    """Lineage columns on every published row. A row that comes from an earlier publication keeps its load."""
    return df.withColumns({"run_id": F.lit(run_id)} | ({} if "load_id" in df.columns else {"load_id": F.lit(load_id)}))


class Timings(dict):
    """Seconds by step of one run."""

    def tick(self, name: str, t0: float) -> float:
        now = time.time()
        self[name] = round(self.get(name, 0.0) + now - t0, 3)
        return now


#: Where the clean and the rejected rows of a Silver table are.
SILVER_PARTS = {"sales": ("sales_checked", "clean"), "sales_rejected": ("sales_checked", "rejected"),
                "events": ("events_checked", "clean"), "events_rejected": ("events_checked", "rejected")}


def _write(spark, df: DataFrame, path: str, run_id: str, load_id: str, facts: dict, key: str,
           layer: str, times: Timings) -> DataFrame:
    t0 = time.time()
    info = A.write_counted(_stamp(df, run_id, load_id), path)
    times.tick("write:" + path.rsplit("/", 2)[-2] + "/" + path.rsplit("/", 1)[-1], t0)
    facts[key] = {"layer": layer, "rows": info["rows"], "columns": len(df.columns)}
    return spark.read.parquet(path).drop("run_id", "load_id")


def _write_checked(spark, flagged: DataFrame, path: str, run_id: str, load_id: str, facts: dict, table: str,
                   columns: list[str], times: Timings, contract: Contract) -> dict[str, int]:
    """Write flagged rows once, by outcome. On the way the rejected rows are counted, and the clean ones with the rules
    that they break by themselves (``rules.row_counters``), which are returned."""
    t0 = time.time()
    rejected = F.col("reject_reason") != ""
    obs = Observation()
    observed = _stamp(flagged, run_id, load_id).observe(obs, *E.row_counters(table, contract, ~rejected), F.count_if(rejected).alias("rejected"))
    with unsorted_writes(spark):
        observed.withColumn("outcome", F.when(rejected, "rejected").otherwise("clean")).write.mode("overwrite").partitionBy("outcome").parquet(path)
    times.tick(f"write:silver/{path.rsplit('/', 1)[-1]}", t0)
    facts[f"silver.{table}"] = {"layer": "silver", "rows": int(obs.get["_rows"]), "columns": len(columns)}
    facts[f"silver.{table}_rejected"] = {"layer": "silver", "rows": int(obs.get["rejected"]), "columns": len(columns) + 1}
    return {rule: int(n) for rule, n in obs.get.items() if rule != "rejected"}


def _parallel(*thunks):
    """Run independent Spark actions as concurrent jobs (driver threads share the
    executors; short stages of one job no longer leave the cluster idle)."""
    if len(thunks) == 1:
        return [thunks[0]()]
    with ThreadPoolExecutor(max_workers=min(len(thunks), MAX_CONCURRENT_JOBS)) as pool:
        futures = [pool.submit(t) for t in thunks]
        return [f.result() for f in futures]


def transform(spark: SparkSession, lake: Lake, load_id: str, contract: Contract, coverage: DataFrame | None,
              run_id: str, raw_rows: dict[str, int], times: Timings | None = None) -> RunResult:
    """Silver and Gold for one landed load, gated; raises ``GateError`` on failure.

    Independent writes run as concurrent jobs.
    """
    times = Timings() if times is None else times
    run = lake.run_dir(run_id)
    facts: dict[str, dict] = {}
    sales_raw = A.read_load(spark, lake.bronze, "sales", load_id)
    events_raw = A.read_load(spark, lake.bronze, "events", load_id)

    def w(df, sub, key="", layer="work", into=None):
        return lambda: _write(spark, df, f"{run}/{sub}", run_id, load_id, facts if into is None else into, key,
                              layer, times)

    s_flagged = S.flag_sales(sales_raw, contract, coverage)
    s_cols = [c for c in s_flagged.columns if c != "reject_reason"]
    e_cols = list(S.SILVER_EVENT_COLS)
    seen: dict[str, dict[str, int]] = {}
    seen["sales"], prepared = _parallel(
        lambda: _write_checked(spark, s_flagged, f"{run}/silver/sales_checked", run_id, load_id, facts, "sales", s_cols, times, contract),
        w(S.prepared_events(events_raw), "work/events_prepared", into={}))
    s_clean, s_rej = (silver_part(spark, run, t, s_cols) for t in ("sales", "sales_rejected"))
    prep = S.prepared_parts(prepared, contract)
    e_flagged = S.flag_events(S.recover_and_fill(prep["typed"], contract, valid_sales=s_clean), s_clean, contract, coverage)
    e_path = f"{run}/silver/events_checked"
    seen["events"] = _write_checked(spark, e_flagged, e_path, run_id, load_id, facts, "events", e_cols, times, contract)
    e_all = spark.read.parquet(e_path)
    e_clean, e_rej = (silver_part(spark, run, t, e_cols) for t in ("events", "events_rejected"))
    incidents = (S.rejected_incidents(s_rej, S.SRC_SALES, S.LVL_SALE, "sale_id")
                 .unionByName(prep["dup_inc"]).unionByName(prep["res_inc"]).unionByName(prep["conf_inc"])
                 .unionByName(S.event_level_incidents(e_all))
                 .unionByName(S.rejected_incidents(e_rej, S.SRC_EVENTS, S.LVL_EVENT, "event_id"))
                 .unionByName(S.order_level_incidents(e_clean, contract)))
    n_rej = {t: F.lit(facts[f"silver.{t}_rejected"]["rows"]) for t in SOURCES}
    silver_rules = E.silver_rules(s_clean, e_clean, contract, F.lit(raw_rows["sales"]), n_rej["sales"],
                                  F.lit(raw_rows["events"]), n_rej["events"], coverage, seen)

    def evaluate(rules: DataFrame, name: str, offenders: Callable[[], DataFrame]) -> list[tuple]:
        t0 = time.time()
        rows = rules_with_details(spark, rules, offenders)
        times.tick(name, t0)
        return rows

    rules_all, _ = _parallel(lambda: evaluate(silver_rules, "silver_rules", lambda: E.silver_offenders(s_clean, e_clean, contract, coverage)),
                             w(incidents, "silver/incidents", "silver.incidents", "silver"))
    remove_path(spark, f"{run}/work")
    try:
        E.gate_rows(rules_all)
    except E.GateError:
        _record(spark, lake, run_id, rules_all, facts)
        raise
    # Gold is only paid for when Silver is good
    orders, gevents = _parallel(w(G.gold_orders(s_clean, e_clean, contract), "gold/orders", "gold.orders", "gold"),
                                w(G.gold_events(s_clean, e_clean), "gold/events", "gold.events", "gold"))
    names = ("kpi_monthly", "carrier_performance", "city_channel_sales")
    fns = (G.kpi_monthly, G.carrier_performance, G.city_channel_sales)
    marts = dict(zip(names, _parallel(*[w(fn(orders), f"gold/{n}", f"gold.{n}", "gold")
                                        for n, fn in zip(names, fns)])))
    gold_rows = evaluate(E.gold_rules(s_clean, e_clean, gevents, orders, marts, contract), "gold_rules", lambda: E.gold_offenders(gevents, orders))
    rules_all = rules_all + gold_rows
    _record(spark, lake, run_id, rules_all, facts)
    E.gate_rows(gold_rows)
    return RunResult(run_id, load_id, "PUBLISHED", rules_all, facts, dict(times))


def rules_with_details(spark: SparkSession, rules: DataFrame, offenders: Callable[[], DataFrame]) -> list[tuple]:
    """The rule rows with their details. What breaks rules is looked for only if a rule fails, so a good run scans nothing twice."""
    rows = [tuple(r) for r in rules.select(*E.RULE_COLS).collect()]
    failed = [r[1] for r in rows if not r[4]]
    if not failed:
        return [(*r, E.plain_detail(r)) for r in rows]
    table = spark.createDataFrame(rows, "layer string, rule_id string, rule string, violations bigint, passed boolean")
    found = E.rule_details(table, offenders().where(F.col("rule_id").isin(failed)))
    details = {r["rule_id"]: r["detail"] for r in found.collect()}
    return [(*r, details[r[1]]) for r in rows]


def silver_part(spark: SparkSession, run: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """The clean or the rejected rows of a run's Silver table."""
    folder, outcome = SILVER_PARTS[table]
    rows = spark.read.parquet(f"{run}/silver/{folder}").where(F.col("outcome") == outcome)
    if columns is None:
        internal = [c for c in rows.columns if c.startswith("_")]
        return rows.drop("outcome", *internal, *(["reject_reason"] if outcome == "clean" else []))
    return rows.select(*columns, *(["reject_reason"] if outcome == "rejected" else []))


def _record(spark, lake: Lake, run_id: str, rules: list[tuple], facts: dict) -> None:
    _parallel(
        lambda: L.append(spark, lake.ledger, "run_rule", [(run_id, *r) for r in rules]),
        lambda: L.append(spark, lake.ledger, "run_table",
                         [(run_id, v["layer"], k.split(".", 1)[1], v["rows"], v["columns"])
                          for k, v in facts.items()]))


def run_pipeline(spark: SparkSession, lake: Lake, sources: dict[str, DataFrame], contract: Contract,
                 coverage: DataFrame | None = None, load_id: str | None = None,
                 overwrite: bool = False) -> RunResult:
    """G1: land the sources as a new load, then transform and publish it. The result's status is
    SUPERSEDED if a newer load was published meanwhile: the run is recorded, the publication stays."""
    load_id = load_id or new_load_id()
    run_id = f"{load_id}-{uuid.uuid4().hex[:8]}"
    times = Timings()

    def work() -> RunResult:
        t0 = time.time()
        facts = A.land_load(spark, lake.bronze, sources, load_id, overwrite)
        times.tick("land", t0)
        L.append(spark, lake.ledger, "run_source",
                 [(run_id, f["source"], load_id, f["rows"], f["columns"], f["fingerprint"], f["kind"], f["origin"]) for f in facts])
        return transform(spark, lake, load_id, contract, coverage, run_id, {f["source"]: f["rows"] for f in facts}, times)
    result = tracked(spark, lake, run_id, load_id, "etl", work)
    retain(spark, lake, contract.max_loads)
    return result


def tracked(spark: SparkSession, lake: Lake, run_id: str, load_id: str, origin: str, work: Callable[[], RunResult],
            base: str | None = None) -> RunResult:
    """Run ``work`` as a run of the ledger: noted when it begins, published when it is good, recorded when it ends.
    A failed run is recorded, the publication stays and the error is raised again (G7)."""
    started = L.begin(spark, lake.ledger, run_id, load_id, origin)
    try:
        with freed_shuffles(spark):
            result = work()
        result.status = "PUBLISHED" if L.publish(spark, lake.ledger, run_id, load_id, origin, base) else "SUPERSEDED"
    except Exception as exc:
        L.end(spark, lake.ledger, run_id, load_id, origin, started, "FAILED", str(exc))
        raise
    L.end(spark, lake.ledger, run_id, load_id, origin, started, result.status)
    return result


def recover(spark: SparkSession, lake: Lake, before: dt.datetime | None = None) -> list[tuple[str, str]]:
    """Close the runs that were killed: begun before a time (a day ago) and never ended. One that had become the
    published run is recorded as PUBLISHED, any other as FAILED and its folder deleted. Returns (run_id, status)."""
    before = before or L.now() - dt.timedelta(days=1)
    out = []
    for run_id, load_id, origin, started in L.unfinished(spark, lake.ledger, before):
        status = "PUBLISHED" if run_id in L.publication_runs(spark, lake.ledger) else "FAILED"
        if status == "FAILED":
            remove_path(spark, lake.run_dir(run_id))
        L.end(spark, lake.ledger, run_id, load_id, origin, started, status, None if status == "PUBLISHED" else "did not finish")
        out.append((run_id, status))
    return out


def reprocess(spark: SparkSession, lake: Lake, contract: Contract, coverage: DataFrame | None = None,
              load_id: str | None = None) -> RunResult:
    """Rebuild Silver/Gold from a landed load (default: newest); sources are
    not contacted. Unknown loads raise listing the available ones. A load whose files were changed since its landing
    is refused (``ChangedLoadError``), recorded as FAILED, and the publication stays."""
    ids = A.list_load_ids(spark, lake.bronze, "sales")
    lid = load_id or (ids[-1] if ids else None)
    if lid is None or lid not in ids:
        raise A.UnknownLoadError(f"unknown load {lid}; available: {', '.join(ids)}")
    run_id = f"{lid}-r{uuid.uuid4().hex[:8]}"

    def work() -> RunResult:
        A.verify_load(spark, lake.bronze, lid)
        return transform(spark, lake, lid, contract, coverage, run_id, _landed_rows(spark, lake, lid))
    return tracked(spark, lake, run_id, lid, "reprocess", work)


def _landed_rows(spark: SparkSession, lake: Lake, load_id: str) -> dict[str, int]:
    """Rows of a load's sources: from the ledger, or counted if it was landed without a run (a stream)."""
    known = (L.read(spark, lake.ledger, "run_source").where(F.col("load_id") == load_id)
             .groupBy("source").agg(F.max_by("rows", "run_id").alias("rows")).collect())
    rows = {r["source"]: r["rows"] for r in known}
    return {s: rows[s] if s in rows else A.read_load(spark, lake.bronze, s, load_id).count() for s in SOURCES}


def retain(spark: SparkSession, lake: Lake, max_loads: int) -> list[str]:
    """Drop the loads beyond the newest ``max_loads``, and the run folders of dropped loads
    except the published one. Returns the dropped loads."""
    gone = A.apply_retention(spark, lake.bronze, SOURCES, max_loads)
    if gone:
        keep = L.published_run(spark, lake.ledger)
        for r in L.read(spark, lake.ledger, "run").where(F.col("load_id").isin(gone)).select("run_id").collect():
            if not keep or r["run_id"] != keep[0]:
                remove_path(spark, lake.run_dir(r["run_id"]))
    return gone


def published(spark: SparkSession, lake: Lake, layer: str, table: str) -> DataFrame:
    """A table of the published run (with its lineage columns)."""
    pr = L.published_run(spark, lake.ledger)
    if pr is None:
        raise LookupError("nothing published yet")
    if layer == "silver" and table in SILVER_PARTS:
        return silver_part(spark, lake.run_dir(pr[0]), table)
    path = f"{lake.run_dir(pr[0])}/{layer}/{table}"
    if not path_exists(spark, path):
        raise LookupError(f"{layer}/{table} not in run {pr[0]}")
    return spark.read.parquet(path)
