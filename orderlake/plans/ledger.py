"""Run ledger: append-only Parquet tables describing every run.

``run`` (one row per run, written when the run ends), ``run_source`` (landed
sources with rows, columns, content fingerprint, kind and origin), ``run_table`` (every
written table with rows x columns), ``run_rule`` (every gate rule with its
detail) and ``run_input`` (the loads that an incremental run publishes). Rows of a
run that has not ended are not visible.

What is published is decided by numbered files in ``_publications``, each naming a run: the
last one is the published run (S26). The next number is taken by an atomic creation, after a look at
the publication before: a run of an older load does not replace a newer load's, whichever
finishes last; reprocessing an older load on purpose does. A run notes in ``_running`` that it has
begun, so that one that was killed can be told and closed (``unfinished``).
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.sources.landing import create_whole, names_in, path_exists, read_small, remove_path, write_aside

SCHEMAS = {
    "run": "run_id string, load_id string, origin string, started_at timestamp, finished_at timestamp, "
           "status string, error string",
    "run_source": "run_id string, source string, load_id string, rows bigint, columns int, fingerprint string, kind string, origin string",
    "run_table": "run_id string, layer string, table string, rows bigint, columns int",
    "run_rule": "run_id string, layer string, rule_id string, rule string, violations bigint, passed boolean, detail string",
    "run_input": "run_id string, source string, load_id string",
}


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def append(spark: SparkSession, ledger_root: str, table: str, rows: list[tuple]) -> None:
    """Append a handful of driver-side rows (run metadata only, never data), as a folder of their own
    that is written beside and renamed: concurrent runs would share, and delete, one temporary folder."""
    if rows:
        made = spark.createDataFrame(rows, SCHEMAS[table]).coalesce(1)
        write_aside(spark, f"{ledger_root}/_staged", f"{ledger_root}/{table}", made.write.parquet)


def read(spark: SparkSession, ledger_root: str, table: str) -> DataFrame:
    """A ledger table; only the rows of runs that have ended."""
    path = f"{ledger_root}/{table}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], SCHEMAS[table])
    rows = spark.read.schema(SCHEMAS[table]).option("recursiveFileLookup", True).parquet(path)
    return rows if table == "run" else rows.join(read(spark, ledger_root, "run").select("run_id"), "run_id", "left_semi")


def begin(spark: SparkSession, ledger_root: str, run_id: str, load_id: str, origin: str) -> dt.datetime:
    """Note that a run has begun."""
    started = now()
    create_whole(spark, f"{ledger_root}/_running/{run_id}", json.dumps([load_id, origin, started.isoformat()]))
    return started


def end(spark: SparkSession, ledger_root: str, run_id: str, load_id: str, origin: str, started: dt.datetime, status: str, error: str | None = None) -> None:
    """Write a run's row, which makes its other rows visible."""
    append(spark, ledger_root, "run", [(run_id, load_id, origin, started, now(), status, error)])
    remove_path(spark, f"{ledger_root}/_running/{run_id}")


def unfinished(spark: SparkSession, ledger_root: str, before: dt.datetime) -> list[tuple[str, str, str, dt.datetime]]:
    """(run_id, load_id, origin, started) of the runs begun before a time that have no row yet."""
    known = {r["run_id"] for r in read(spark, ledger_root, "run").select("run_id").collect()}
    out = []
    for run_id in names_in(spark, f"{ledger_root}/_running"):
        if run_id.startswith("."):
            continue
        load_id, origin, started = json.loads(read_small(spark, f"{ledger_root}/_running/{run_id}"))
        if run_id in known:  # killed between its row and the note's removal
            remove_path(spark, f"{ledger_root}/_running/{run_id}")
        elif dt.datetime.fromisoformat(started) < before:
            out.append((run_id, load_id, origin, dt.datetime.fromisoformat(started)))
    return out


def _publications(spark: SparkSession, ledger_root: str) -> list[int]:
    return [int(n) for n in names_in(spark, f"{ledger_root}/_publications") if n.isdigit()]


def _publication(spark: SparkSession, ledger_root: str, number: int) -> list[str]:
    return json.loads(read_small(spark, f"{ledger_root}/_publications/{number:09d}"))


def publish(spark: SparkSession, ledger_root: str, run_id: str, load_id: str, origin: str, base: str | None = None) -> bool:
    """Make a run the published one; False if it may not be.

    A run of a new load (origin ``etl``) may not replace a newer load. With ``base`` (incremental
    runs) the run that it builds on must still be the published one.
    """
    while True:
        numbers = _publications(spark, ledger_root)
        last = _publication(spark, ledger_root, numbers[-1]) if numbers else None
        if last and origin == "etl" and last[1] > load_id:
            return False
        if base is not None and base != (last[0] if last else ""):
            return False
        if create_whole(spark, f"{ledger_root}/_publications/{(numbers or [0])[-1] + 1:09d}", json.dumps([run_id, load_id])):
            return True


def published_run(spark: SparkSession, ledger_root: str) -> tuple[str, str] | None:
    """(run_id, load_id) of the published run, or None."""
    numbers = _publications(spark, ledger_root)
    return tuple(_publication(spark, ledger_root, numbers[-1])) if numbers else None


def publication_runs(spark: SparkSession, ledger_root: str) -> set[str]:
    """The runs that are or were published."""
    return {_publication(spark, ledger_root, n)[0] for n in _publications(spark, ledger_root)}


def run_history(spark: SparkSession, ledger_root: str, last: int = 8) -> DataFrame:
    """The newest ``last`` runs with rules passed / total and whether the run
    used the newest landed load (top-k over the ledger: ``last`` is the feature)."""
    runs = read(spark, ledger_root, "run")
    rules = (read(spark, ledger_root, "run_rule").groupBy("run_id")
             .agg(F.count_if("passed").alias("rules_passed"), F.count(F.lit(1)).alias("rules_total")))
    newest_load = runs.agg(F.max("load_id")).scalar()
    seq = F.row_number().over(Window.orderBy("started_at", "run_id"))  # ledger rows: one per run
    return (runs.join(rules, "run_id", "left")
            .withColumn("seq", seq)
            .withColumn("rules_passed", F.coalesce("rules_passed", F.lit(0)))
            .withColumn("rules_total", F.coalesce("rules_total", F.lit(0)))
            .withColumn("on_newest_load", F.col("load_id") == newest_load)
            .orderBy(F.desc("seq")).limit(last))
