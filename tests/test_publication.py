"""Publication pointer, killed runs, landing anew while readers read, builds that are killed."""

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from given_tables import SF_SMALL
from orderlake import registry as R
from orderlake.contract import TOLERANT_CONTRACT
from orderlake.plans import ledger as L
from orderlake.plans import pipeline as PL
from orderlake.plans.pipeline import Lake, recover, reprocess, run_pipeline
from orderlake.sources import bronze as A
from orderlake.sources import fixtures as FX
from orderlake.sources import landing
from orderlake.sources.landing import built_once, create_whole, path_exists, read_small

OLD, NEW = "20240101_000000", "20240102_000000"


class Killed(BaseException):
    """Not an Exception: like a signal, it passes the handlers of failed runs."""


def _sources(spark):
    return {"sales": R.bronze_sales(spark, SF_SMALL), "events": R.bronze_events(spark, SF_SMALL)}


def test_a_name_is_taken_once(spark, tmpdir_spark):
    path = f"{tmpdir_spark}/pointers/000001"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: create_whole(spark, path, f"writer {i}" * 100), range(16)))
    assert made.count(True) == 1 and read_small(spark, path) == f"writer {made.index(True)}" * 100
    assert landing.names_in(spark, f"{tmpdir_spark}/pointers") == ["000001"]


def test_an_older_load_that_ends_last_does_not_replace_a_newer_one(spark, tmpdir_spark, monkeypatch):
    lake, cov, src = Lake(tmpdir_spark), FX.coverage(spark, SF_SMALL), _sources(spark)
    newer_is_out = threading.Event()
    plain = PL.G.gold_orders

    def slow(sales, events, contract):
        if threading.current_thread().name == "older":
            assert newer_is_out.wait(300)
        return plain(sales, events, contract)
    monkeypatch.setattr(PL.G, "gold_orders", slow)
    # the slow step of a run is submitted to a pool, so the older run's own thread is told by its parallel helper
    monkeypatch.setattr(PL, "_parallel", lambda *thunks: [t() for t in thunks])
    results = {}
    older = threading.Thread(target=lambda: results.update(old=run_pipeline(spark, lake, src, TOLERANT_CONTRACT, cov, load_id=OLD)), name="older")
    older.start()
    results["new"] = run_pipeline(spark, lake, src, TOLERANT_CONTRACT, cov, load_id=NEW)
    newer_is_out.set()
    older.join()
    assert (results["old"].status, results["new"].status) == ("SUPERSEDED", "PUBLISHED")
    assert L.published_run(spark, lake.ledger) == (results["new"].run_id, NEW)
    ended = L.read(spark, lake.ledger, "run").orderBy("finished_at").collect()
    assert [(r["load_id"], r["status"]) for r in ended] == [(NEW, "PUBLISHED"), (OLD, "SUPERSEDED")]
    # an older load that is reprocessed on purpose is published
    again = reprocess(spark, lake, TOLERANT_CONTRACT, cov, load_id=OLD)
    assert again.status == "PUBLISHED" and L.published_run(spark, lake.ledger) == (again.run_id, OLD)


def test_a_killed_run_leaves_nothing_visible_and_is_closed(spark, tmpdir_spark, monkeypatch):
    lake, cov, src = Lake(tmpdir_spark), FX.coverage(spark, SF_SMALL), _sources(spark)

    def die(*_):
        raise Killed
    with monkeypatch.context() as m:
        m.setattr(PL.G, "gold_orders", die)
        with pytest.raises(Killed):
            run_pipeline(spark, lake, src, TOLERANT_CONTRACT, cov, load_id=OLD)
    assert L.published_run(spark, lake.ledger) is None
    assert all(L.read(spark, lake.ledger, t).count() == 0 for t in L.SCHEMAS)
    assert recover(spark, lake) == []  # begun less than a day ago: it might still run
    (run_id, status), = recover(spark, lake, L.now() + dt.timedelta(seconds=1))
    assert status == "FAILED" and not path_exists(spark, lake.run_dir(run_id))
    assert [tuple(r) for r in L.read(spark, lake.ledger, "run").select("status", "error").collect()] == [("FAILED", "did not finish")]
    assert recover(spark, lake, L.now() + dt.timedelta(seconds=1)) == []
    # killed after it had become the published run, before its row
    with monkeypatch.context() as m:
        m.setattr(L, "end", die)
        with pytest.raises(Killed):
            run_pipeline(spark, lake, src, TOLERANT_CONTRACT, cov, load_id=OLD, overwrite=True)
    run = L.published_run(spark, lake.ledger)[0]
    assert recover(spark, lake, L.now() + dt.timedelta(seconds=1)) == [(run, "PUBLISHED")]
    assert PL.published(spark, lake, "gold", "orders").count() > 0


def _table(spark, n):
    return {"sales": spark.range(n).select("id", F.lit(n).alias("n")), "events": spark.range(2 * n)}


def test_a_reader_sees_the_old_or_the_new_load_while_it_is_landed_anew(spark, tmpdir_spark, monkeypatch):
    root = f"{tmpdir_spark}/bronze"
    A.land_load(spark, root, _table(spark, 10), OLD)
    reader = A.read_load(spark, root, "sales", OLD)
    seen = []
    commit = A.commit_load

    def watched(*args):
        seen.append(A.read_load(spark, root, "sales", OLD).count())  # new files are whole, not committed
        commit(*args)
        seen.append(A.read_load(spark, root, "sales", OLD).count())
    with monkeypatch.context() as m:
        m.setattr(A, "commit_load", watched)
        A.land_load(spark, root, _table(spark, 25), OLD, overwrite=True)
    assert seen == [10, 25] and reader.count() == 10  # a reader that had begun ends on what it began with
    with pytest.raises(A.LoadExistsError):
        A.land_load(spark, root, _table(spark, 3), OLD)
    # a landing that dies between its sources leaves the load as it was
    with monkeypatch.context() as m:
        m.setattr(A, "commit_load", lambda *_: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            A.land_load(spark, root, _table(spark, 99), OLD, overwrite=True)
    assert [A.read_load(spark, root, s).count() for s in ("sales", "events")] == [25, 50]
    A.land_load(spark, root, _table(spark, 30), OLD, overwrite=True)
    generations = [n for n in landing.names_in(spark, f"{root}/sales/load_id={OLD}")]
    assert A.read_load(spark, root, "sales").count() == 30 and len(generations) == 3  # now, before, and the one never committed
    with pytest.raises(ValueError, match="schema drift"):
        A.land_load(spark, root, {"sales": spark.range(3)}, NEW)
    assert A.list_load_ids(spark, root, "sales") == [OLD]


def _changed(spark, root, how):
    """Write the landed files of OLD's sales anew with other rows."""
    folder = A.load_folder(spark, root, "sales", OLD)
    rows = spark.read.parquet(folder)
    held = spark.createDataFrame(how(rows).collect(), rows.schema)
    held.coalesce(1).write.mode("overwrite").parquet(folder)


def test_changed_files_of_a_load_are_told(spark, tmpdir_spark):
    root = f"{tmpdir_spark}/bronze"
    A.land_load(spark, root, {**_table(spark, 10), "empty": spark.range(0)}, OLD)
    assert A.verify_load(spark, root, OLD) == ["empty", "events", "sales"]
    with pytest.raises(A.UnknownLoadError):
        A.verify_load(spark, root, NEW)
    changes = [lambda d: d.limit(9), lambda d: d.unionByName(d.limit(1)), lambda d: d.withColumn(d.columns[0], F.lit(None).cast(d.schema[0].dataType))]
    for how in changes:
        A.land_load(spark, root, {**_table(spark, 10), "empty": spark.range(0)}, OLD, overwrite=True)
        assert A.verify_load(spark, root, OLD) == ["empty", "events", "sales"]
        _changed(spark, root, how)
        with pytest.raises(A.ChangedLoadError, match="sales of load"):
            A.verify_load(spark, root, OLD)


def test_a_changed_load_is_not_reprocessed(spark, tmpdir_spark):
    lake, cov = Lake(f"{tmpdir_spark}/lake"), FX.coverage(spark, SF_SMALL)
    first = run_pipeline(spark, lake, _sources(spark), TOLERANT_CONTRACT, cov, load_id=OLD)
    facts = {r["source"]: (r["kind"], r["origin"]) for r in L.read(spark, lake.ledger, "run_source").collect()}
    assert set(facts) == {"sales", "events"} and all(kind in ("files", "query") and bool(origin) == (kind == "files") for kind, origin in facts.values())
    _changed(spark, lake.bronze, lambda d: d.where(F.col(d.columns[0]) > d.agg(F.min(d.columns[0])).first()[0]))
    with pytest.raises(A.ChangedLoadError):
        reprocess(spark, lake, TOLERANT_CONTRACT, cov, load_id=OLD)
    assert L.published_run(spark, lake.ledger)[0] == first.run_id
    assert [r["status"] for r in L.read(spark, lake.ledger, "run").orderBy("started_at").collect()] == ["PUBLISHED", "FAILED"]


def test_origin_is_the_folder_of_the_files(spark, tmpdir_spark):
    for part in ("a", "b"):
        spark.range(3).write.parquet(f"{tmpdir_spark}/x/{part}")
    one, both = spark.read.parquet(f"{tmpdir_spark}/x/a"), spark.read.parquet(f"{tmpdir_spark}/x/a", f"{tmpdir_spark}/x/b")
    assert A.origin_of(one.where("id > 1")) == ("files", f"file://{tmpdir_spark}/x/a")
    assert A.origin_of(both) == ("files", f"file://{tmpdir_spark}/x")
    assert A.origin_of(spark.range(3)) == ("query", "")


def test_a_killed_build_is_built_again_whole(spark, tmpdir_spark):
    calls = []

    def build(folder):
        calls.append(folder)
        spark.range(len(calls)).write.parquet(f"{folder}/one")
        if len(calls) == 1:
            raise Killed
    path = f"{tmpdir_spark}/scenario"
    with pytest.raises(Killed):
        built_once(spark, path, build)
    assert not path_exists(spark, path)
    for _ in range(2):
        assert built_once(spark, path, build) == path and spark.read.parquet(f"{path}/one").count() == 2
    assert len(calls) == 2


def test_the_scenario_lake_survives_a_kill(spark, monkeypatch, tmpdir_spark):
    """Killed in its second run and called again, the history has its three runs."""
    monkeypatch.setattr(PL.Lake, "in_checkpoint_dir", staticmethod(lambda spark, name: Lake(f"{tmpdir_spark}/{name}")))
    with monkeypatch.context() as m:
        m.setattr(PL, "reprocess", lambda *a, **k: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            R.scenario_lake(spark, SF_SMALL)
    lake = R.scenario_lake(spark, SF_SMALL)
    assert [r["status"] for r in L.read(spark, lake.ledger, "run").orderBy("started_at").collect()] == ["PUBLISHED", "PUBLISHED", "FAILED"]
