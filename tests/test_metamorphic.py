"""Metamorphic: repartitioning or duplicating the input must not change Silver/Gold."""

from pyspark.sql import functions as F

from given_tables import SF_SMALL
from orderlake import registry as R
from orderlake.contract import FIXTURE_CONTRACT as C
from orderlake.operators import gold as G
from orderlake.operators import silver as S
from orderlake.sources import fixtures as FX


def _silver_gold(sales, events, cov):
    s_clean, _ = S.split_quarantine(S.flag_sales(sales, C, cov))
    ev = S.silver_events(events, s_clean, C, cov)
    return s_clean, ev["clean"], G.carrier_performance(G.gold_orders(s_clean, ev["clean"], C))


def _rows(df):
    return sorted(map(str, df.collect()))


def test_partitioning_does_not_change_results(spark):
    sales, events, cov = R.bronze_sales(spark, SF_SMALL), R.bronze_events(spark, SF_SMALL), FX.coverage(spark, SF_SMALL)
    a = _silver_gold(sales, events, cov)
    b = _silver_gold(sales.repartition(7, F.rand(1)), events.repartition(5, F.rand(2)), cov)
    for x, y in zip(a, b):
        assert _rows(x) == _rows(y)


def test_appending_an_exact_copy_gives_the_same_silver(spark):
    sales, events, cov = R.bronze_sales(spark, SF_SMALL), R.bronze_events(spark, SF_SMALL), FX.coverage(spark, SF_SMALL)
    a = _silver_gold(sales, events, cov)
    b = _silver_gold(sales.unionByName(sales), events.unionByName(events), cov)
    for x, y in zip(a, b):
        assert _rows(x) == _rows(y)
