"""Dirty parent/child views over the driver's TPC-H-ish tables.

``sales_raw`` (one row per order, with injected defects) and ``events_raw``
(one row per milestone event of an order) are written once as SQL text. The
same text runs in Spark and in DuckDB; only three spots differ by dialect:
the text type, adding hours to a timestamp and integer division.

Defects are injected by key arithmetic so both engines produce the very same
rows. Every order is a sale, also one without lines (null amounts), and every
line counts: a sale's quantity is the sum over its lines and its unit price
their mean price per piece. Every line is an event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")

_DIALECT = {
    "spark": {"text": "string", "add_hours": "timestampadd(HOUR, {h}, {ts})", "div": "div"},
    "duckdb": {"text": "varchar", "add_hours": "({ts} + to_hours(CAST({h} AS BIGINT)))", "div": "//"},
}


def _tables(dialect: str, *names: str) -> dict[str, str]:
    """Spark binds tables as DataFrame arguments of ``spark.sql`` (no global views)."""
    return {n: ("{" + n + "}" if dialect == "spark" else n) for n in names}


def _add_hours(dialect: str, ts: str, h: str) -> str:
    return _DIALECT[dialect]["add_hours"].format(ts=ts, h=h)


def sales_raw_sql(dialect: str = "spark") -> str:
    """One sale per order: orders ⋈ customer ⋈ nation, with the order's lines summed up.

    Category and product are those of the first line."""
    t, div = _DIALECT[dialect]["text"], _DIALECT[dialect]["div"]
    T = _tables(dialect, "lineitem", "orders", "customer", "nation", "part")
    return f"""
WITH priced_lines AS (
  SELECT l.l_orderkey, p.p_type, p.p_name, CAST(l.l_quantity AS BIGINT) AS quantity,
         CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents,
         CAST(CAST(l.l_discount AS DECIMAL(5,2)) * 100 AS BIGINT) AS discount_pct,
         row_number() OVER (PARTITION BY l.l_orderkey
                            ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate,
                                     l.l_quantity, l.l_extendedprice) AS rn
  FROM {T['lineitem']} l JOIN {T['part']} p ON p.p_partkey = l.l_partkey
),
per_order AS (
  SELECT l_orderkey, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(quantity * cents) AS BIGINT) AS cents,
         CAST(sum(discount_pct) AS BIGINT) AS discount_pct, count(*) AS n_lines,
         max(CASE WHEN rn = 1 THEN p_type END) AS p_type, max(CASE WHEN rn = 1 THEN p_name END) AS p_name
  FROM priced_lines GROUP BY l_orderkey
),
base AS (
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderdate, o.o_orderpriority,
         c.c_mktsegment, replace(n.n_name, '_', ' ') AS nation_city,
         po.p_type, po.p_name,
         CAST(((po.cents + (po.quantity {div} 2)) {div} po.quantity) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS unit_price,
         CAST(po.quantity AS INT) AS quantity,
         CAST((po.discount_pct {div} po.n_lines) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,2)) AS discount_rate
  FROM {T['orders']} o
  JOIN {T['customer']} c ON c.c_custkey = o.o_custkey
  JOIN {T['nation']} n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN per_order po ON po.l_orderkey = o.o_orderkey
),
priced AS (
  SELECT *,
         CAST(unit_price * quantity + CASE WHEN k % 1103 = 0 THEN 5 ELSE 0 END AS DECIMAL(18,2)) AS gross
  FROM base
),
discounted AS (
  SELECT *,
         CASE WHEN k % 1201 = 0 THEN CAST(-1 AS DECIMAL(18,2))
              ELSE CAST(gross * discount_rate AS DECIMAL(18,2)) END AS discount
  FROM priced
),
sale AS (
  SELECT k AS sale_id,
         k AS order_id,
         CASE WHEN k % 1009 = 0 THEN NULL ELSE o_orderdate END AS sale_ts,
         o_custkey AS customer_id,
         CASE WHEN k % 211 = 0 THEN '  ' || replace(nation_city, ' ', '  ') || ' '
              WHEN k % 307 = 0 THEN 'Atlantis'
              ELSE nation_city END AS city,
         c_mktsegment AS channel,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'ST-' || CAST(o_custkey % 10 AS {t}) END AS store_id,
         p_type AS category,
         p_name AS product,
         o_orderpriority AS pay_method,
         quantity,
         unit_price,
         discount_rate,
         gross,
         discount,
         CAST(gross - discount - CASE WHEN k % 1301 = 0 THEN 5 ELSE 0 END AS DECIMAL(18,2)) AS net,
         CASE WHEN k % 7 < 3 THEN NULL
              WHEN k % 401 = 0 THEN 9
              ELSE CAST(1 + (k % 11) % 5 AS INT) END AS rating
  FROM discounted
)
SELECT sale_id, order_id, sale_ts, customer_id, city, channel, store_id, category, product,
       pay_method, quantity, unit_price, discount_rate, gross, discount, net, rating
FROM sale
UNION ALL
SELECT sale_id, order_id, sale_ts, customer_id, city, channel, store_id, category, product,
       'ZZ-DUP' AS pay_method, quantity, unit_price, discount_rate, gross, discount, net, rating
FROM sale WHERE sale_id % 1409 = 0
"""


def events_raw_sql(dialect: str = "spark") -> str:
    """One row per line item = one milestone event, plus exact copies of some rows."""
    t = _DIALECT[dialect]["text"]
    ev_ts = _add_hours(dialect, "o.o_orderdate", "(l.l_linenumber * 20 + l.l_partkey % 30)")
    pr_ts = _add_hours(dialect, "o.o_orderdate", "(72 + l.l_orderkey % 48)")
    T = _tables(dialect, "lineitem", "orders", "customer", "nation")
    return f"""
WITH ev AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS event_id,
         CASE WHEN l.l_orderkey % 1999 = 0 THEN l.l_orderkey + 900000000 ELSE l.l_orderkey END AS order_id,
         CASE WHEN l.l_partkey % 97 = 0 THEN NULL
              WHEN l.l_partkey % 89 = 0 THEN 'bad-date'
              ELSE CAST({ev_ts} AS {t}) END AS event_ts_txt,
         l.l_returnflag AS state,
         CASE WHEN l.l_suppkey % 40 = 0 THEN NULL ELSE 'DC-' || CAST(l.l_orderkey % 6 AS {t}) END AS center,
         CASE WHEN l.l_partkey % 71 = 0 THEN NULL ELSE replace(n.n_name, '_', ' ') END AS dest_city,
         CASE WHEN l.l_returnflag IN ('A', 'R') AND l.l_partkey % 50 <> 0
              THEN 'CAR-' || CAST(l.l_orderkey % 5 AS {t}) END AS carrier,
         CASE WHEN l.l_returnflag NOT IN ('A', 'R') OR l.l_partkey % 61 = 0 THEN NULL
              WHEN l.l_orderkey % 1000 = 7 THEN 'TRK7'
              ELSE 'TRK' || CAST(l.l_orderkey AS {t}) END AS tracking_no,
         CASE WHEN l.l_partkey % 83 = 0 THEN NULL ELSE CAST({pr_ts} AS {t}) END AS promised_ts_txt,
         CASE WHEN l.l_linenumber = 1 THEN NULL ELSE l.l_quantity END AS stage_hours,
         CAST(8900 + (l.l_orderkey % 12) * 1000 AS INT) AS ship_cost,
         CASE WHEN l.l_partkey % 100 = 1 THEN 'INC-' || CAST(l.l_partkey % 6 AS {t}) END AS incident,
         CASE WHEN l.l_partkey % 30 = 2 THEN ' OBS  ' || CAST(l.l_partkey % 9 AS {t}) END AS note,
         CASE WHEN l.l_orderkey % 5000 = 3 AND l.l_linenumber = 1 THEN 'x' END AS unnamed_13
  FROM {T['lineitem']} l
  JOIN {T['orders']} o ON o.o_orderkey = l.l_orderkey
  JOIN {T['customer']} c ON c.c_custkey = o.o_custkey
  JOIN {T['nation']} n ON n.n_nationkey = c.c_nationkey
)
SELECT * FROM ev
UNION ALL
SELECT * FROM ev WHERE event_id % 503 = 0
"""


def coverage_sql(dialect: str = "duckdb") -> str:
    """Coverage list of the fixture = the 25 cleaned nation names."""
    return f"SELECT DISTINCT replace(n_name, '_', ' ') AS city FROM {_tables(dialect, 'nation')['nation']}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bind(spark: SparkSession, sf_dir: str, sql: str, names) -> DataFrame:
    return spark.sql(sql, **{n: read_table(spark, sf_dir, n) for n in names})


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bind(spark, sf_dir, sales_raw_sql("spark"), ("orders", "customer", "nation", "lineitem", "part"))


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bind(spark, sf_dir, events_raw_sql("spark"), ("orders", "customer", "nation", "lineitem"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bind(spark, sf_dir, coverage_sql("spark"), ("nation",))


def duckdb_ctes() -> str:
    """``sales_raw``, ``events_raw`` and ``coverage`` as DuckDB CTE text (no leading WITH)."""
    return (f"sales_raw AS ({sales_raw_sql('duckdb')}),\n"
            f"events_raw AS ({events_raw_sql('duckdb')}),\n"
            f"coverage AS ({coverage_sql('duckdb')})")
