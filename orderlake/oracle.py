"""DuckDB twins of the registered queries (the correctness gate).

Each entry is plain SQL over the driver's base views. The fixture views are
prepended as CTEs, written once in ``sources.fixtures``. The SQL is written
independently of the DataFrame code: it states the same semantics with SQL
constructs (windows, FILTER clauses, CASE), so agreement is evidence.

Dialect notes: ``round_even(x*100,0)/100`` is half-even rounding; sums are
cast to DECIMAL(38,2) and counts to BIGINT so result types agree with Spark.
"""

from __future__ import annotations

from orderlake.sources.fixtures import duckdb_ctes

CITY_F2 = "NATION 1"


def r2(expr: str, digits: int = 2) -> str:
    scale = 10 ** digits
    return f"(round_even(CAST({expr} AS DOUBLE) * {scale}, 0) / {scale})"


def with_fixtures(*ctes: str, select: str) -> str:
    parts = [duckdb_ctes()] + [c for c in ctes if c]
    return "WITH " + ",\n".join(parts) + "\n" + select


# ------------------------------------------------------------------ F
ORDER_FIRST = """order_first AS (
  SELECT order_id,
         arg_min(dest_city, {'e': event_id, 'v': dest_city}) FILTER (WHERE dest_city IS NOT NULL) AS dest_city,
         arg_min(ship_cost, {'e': event_id, 'v': ship_cost}) FILTER (WHERE ship_cost IS NOT NULL) AS ship_cost
  FROM events_raw GROUP BY order_id)"""

ORDER_COSTS = """order_costs AS (
  SELECT f.order_id, f.dest_city, f.ship_cost, s.category, s.quantity, s.net
  FROM order_first f JOIN sales_raw s ON s.order_id = f.order_id)"""


def f_queries() -> dict[str, str]:
    q = {}
    q["q01_net_by_channel"] = with_fixtures(select=f"""
SELECT channel, CAST(sum(net) AS DECIMAL(38,2)) AS net,
       {r2("CAST(sum(net) AS DOUBLE) / (SELECT CAST(sum(net) AS DOUBLE) FROM sales_raw) * 100")} AS share_pct
FROM sales_raw GROUP BY channel""")
    q["q02_city_category"] = with_fixtures(f"""agg AS (
  SELECT category, CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(net) AS DECIMAL(38,2)) AS net
  FROM sales_raw WHERE city = '{CITY_F2}' GROUP BY category)""", select="""
SELECT category, units, net,
       row_number() OVER (ORDER BY units DESC, category) AS units_rank,
       row_number() OVER (ORDER BY net DESC, category) AS net_rank
FROM agg""")
    per_cust = "per_cust AS (SELECT customer_id, count(*) AS purchases FROM sales_raw GROUP BY customer_id)"
    q["q03_recurrence_distribution"] = with_fixtures(per_cust, select="""
SELECT purchases AS purchases_per_customer, count(*) AS customers FROM per_cust GROUP BY purchases""")
    q["q03_recurrence_kpis"] = with_fixtures(per_cust, select=f"""
SELECT count(*) AS customers,
       count(*) FILTER (WHERE purchases > 1) AS repeat_customers,
       max(purchases) AS max_purchases,
       {r2("(count(*) FILTER (WHERE purchases > 1)) / count(*) * 100")} AS repeat_pct,
       {r2("CAST(sum(CASE WHEN purchases > 1 THEN purchases ELSE 0 END) AS DOUBLE) / sum(purchases) * 100")}
         AS sales_by_repeat_pct
FROM per_cust""")
    q["q04_discount_share"] = with_fixtures(select=f"""
SELECT {r2("CAST(sum(discount) AS DOUBLE) / CAST(sum(gross) AS DOUBLE) * 100")} AS discount_pct_of_gross,
       {r2("avg(CASE WHEN discount_rate > 0 THEN 1.0 ELSE 0.0 END) * 100")} AS pct_sales_with_discount
FROM sales_raw""")
    q["q05_stage_hours_by_carrier"] = with_fixtures(select=f"""
SELECT carrier, {r2("avg(stage_hours)")} AS mean_stage_hours,
       {r2("(SELECT avg(stage_hours) FROM events_raw)")} AS overall_mean_stage_hours
FROM events_raw WHERE carrier IS NOT NULL GROUP BY carrier""")
    q["q06_top_products"] = with_fixtures("""per AS (
  SELECT product, category, CAST(sum(net) AS DECIMAL(38,2)) AS net FROM sales_raw GROUP BY product, category)""",
        """cat AS (SELECT category, sum(net) AS category_net FROM per GROUP BY category)""", select=f"""
SELECT p.product, p.category, p.net,
       {r2("CAST(p.net AS DOUBLE) / CAST(c.category_net AS DOUBLE) * 100")} AS category_share_pct
FROM per p JOIN cat c ON c.category = p.category
ORDER BY p.net DESC, p.product, p.category LIMIT 5""")
    q["q07_cost_by_city"] = with_fixtures(ORDER_FIRST, ORDER_COSTS, select=f"""
SELECT dest_city, {r2("avg(ship_cost)")} AS mean_cost, count(DISTINCT ship_cost) AS tariffs
FROM order_costs WHERE dest_city IS NOT NULL GROUP BY dest_city""")
    q["q07_cost_by_category"] = with_fixtures(ORDER_FIRST, ORDER_COSTS, select=f"""
SELECT category, {r2("avg(ship_cost)")} AS mean_cost
FROM order_costs WHERE category IS NOT NULL GROUP BY category""")
    q["q07_cost_corr"] = with_fixtures(ORDER_FIRST, ORDER_COSTS, select=f"""
SELECT {r2("corr(CAST(ship_cost AS DOUBLE), CAST(quantity AS DOUBLE))", 6)} AS corr_cost_quantity,
       {r2("corr(CAST(ship_cost AS DOUBLE), CAST(net AS DOUBLE))", 6)} AS corr_cost_net,
       count(DISTINCT ship_cost) AS tariffs
FROM order_costs""")
    q["q08_incident_rate"] = with_fixtures(select=f"""
SELECT count(*) AS events, count(incident) AS events_with_incident,
       {r2("avg(CASE WHEN incident IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100")} AS pct_events_with_incident,
       count(DISTINCT order_id) FILTER (WHERE incident IS NOT NULL) AS orders_with_incident,
       count(DISTINCT order_id) AS orders,
       {r2("(count(DISTINCT order_id) FILTER (WHERE incident IS NOT NULL)) / count(DISTINCT order_id) * 100")}
         AS pct_orders_with_incident
FROM events_raw""")
    q["q09_payment_channel"] = with_fixtures(select="""
SELECT pay_method, channel, count(*) AS n FROM sales_raw GROUP BY pay_method, channel""")
    q["q09_exclusive_methods"] = with_fixtures("""per AS (
  SELECT pay_method, channel, count(*) AS n FROM sales_raw GROUP BY pay_method, channel)""", select="""
SELECT pay_method, count(*) AS n_channels, count(*) = 1 AS exclusive,
       CASE WHEN count(*) = 1 THEN min(channel) END AS exclusive_channel,
       CAST(sum(CASE WHEN channel <> 'BUILDING' THEN n ELSE 0 END) AS BIGINT) AS sales_outside_physical
FROM per GROUP BY pay_method""")
    q["q10_avg_net_by_city"] = with_fixtures(select=f"""
SELECT city, {r2("avg(net)", 0)} AS avg_net FROM sales_raw GROUP BY city""")
    q["concentration_top3"] = with_fixtures("""per AS (
  SELECT city, sum(net) AS net FROM sales_raw GROUP BY city ORDER BY net DESC, city LIMIT 3)""", select=f"""
SELECT CAST(sum(net) AS DECIMAL(38,2)) AS top3_net, count(*) AS cities,
       {r2("CAST(sum(net) AS DOUBLE) / (SELECT CAST(sum(net) AS DOUBLE) FROM sales_raw) * 100")} AS top3_share_pct
FROM per""")
    q["rating_high_share"] = with_fixtures(select=f"""
SELECT count(rating) AS rated, count(*) FILTER (WHERE rating IN (4, 5)) AS high,
       {r2("(count(*) FILTER (WHERE rating IN (4, 5))) * 100.0 / nullif(count(rating), 0)")} AS high_pct
FROM sales_raw""")
    q["best_month"] = with_fixtures(select="""
SELECT strftime(sale_ts, '%Y-%m') AS month, CAST(sum(net) AS DECIMAL(38,2)) AS net
FROM sales_raw WHERE sale_ts IS NOT NULL GROUP BY 1 ORDER BY net DESC, month LIMIT 1""")
    q["channel_transaction_share"] = with_fixtures(select=f"""
SELECT channel, count(*) AS transactions,
       {r2("count(*) / (SELECT count(*) FROM sales_raw) * 100")} AS share_pct
FROM sales_raw GROUP BY channel""")
    q["category_value_vs_transactions"] = with_fixtures("""per AS (
  SELECT category, CAST(sum(net) AS DECIMAL(38,2)) AS net, count(*) AS transactions
  FROM sales_raw GROUP BY category)""", select="""
SELECT category, net, transactions,
       row_number() OVER (ORDER BY net DESC, category) AS net_rank,
       row_number() OVER (ORDER BY transactions DESC, category) AS transactions_rank
FROM per""")
    q["net_skew"] = with_fixtures("""m AS (SELECT avg(CAST(net AS DOUBLE)) AS mu FROM sales_raw)""", select=f"""
SELECT {r2("avg(CASE WHEN quantity = 1 THEN 1.0 ELSE 0.0 END) * 100")} AS single_unit_pct,
       {r2("avg(net)")} AS mean_net,
       {r2("quantile_cont(CAST(net AS DOUBLE), 0.5)")} AS median_net,
       {r2("avg(power(CAST(net AS DOUBLE) - m.mu, 3)) / power(avg(power(CAST(net AS DOUBLE) - m.mu, 2)), 1.5)", 4)}
         AS skewness_net
FROM sales_raw, m""")
    return q


# ------------------------------------------------------------------ C (Silver)
def _clean(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


SALES_COLS = ("sale_id", "order_id", "sale_ts", "customer_id", "city", "channel", "store_id", "category",
              "product", "pay_method", "quantity", "unit_price", "discount_rate", "gross", "discount", "net",
              "rating")
EV_RAW_COLS = ("event_id", "order_id", "event_ts_txt", "state", "center", "dest_city", "carrier", "tracking_no",
               "promised_ts_txt", "stage_hours", "ship_cost", "incident", "note")
EV_COLS = ("event_id", "order_id", "event_ts", "state", "center", "dest_city", "carrier", "tracking_no",
           "promised_ts", "stage_hours", "ship_cost", "incident", "note")
TRANSPORT = "('A', 'R')"
DELIVERED = "'R'"


def _all_nulls_first(cols) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


SALES_TEXT = ("city", "channel", "category", "product", "pay_method", "store_id")
SILVER_SALES_CTES = [
    "s_dedup AS (SELECT DISTINCT * FROM sales_raw)",
    "s_typed AS (SELECT " + ", ".join(
        _clean(c) + f" AS {c}" if c in SALES_TEXT else ("CAST(rating AS INTEGER) AS rating" if c == "rating" else c)
        for c in SALES_COLS) + " FROM s_dedup)",
    f"""s_flag AS (
  SELECT *,
    concat_ws('; ',
      CASE WHEN sale_ts IS NULL THEN 'fecha_venta nula o inválida' END,
      CASE WHEN NOT coalesce(city IN (SELECT city FROM coverage), false) THEN 'ciudad fuera de cobertura' END,
      CASE WHEN coalesce(unit_price < 0, false) OR coalesce(gross < 0, false) OR coalesce(discount < 0, false)
                OR coalesce(net < 0, false) THEN 'montos negativos' END,
      CASE WHEN coalesce(abs(unit_price * quantity - gross) > 1, false)
                OR coalesce(abs(gross - discount - net) > 1, false) THEN 'montos inconsistentes' END,
      CASE WHEN rating IS NOT NULL AND NOT coalesce(rating BETWEEN 1 AND 5, false) THEN 'calificacion fuera de 1-5' END,
      CASE WHEN row_number() OVER (PARTITION BY sale_id ORDER BY {_all_nulls_first(SALES_COLS)}) > 1
           THEN 'id_venta repetido' END,
      CASE WHEN row_number() OVER (PARTITION BY order_id ORDER BY {_all_nulls_first(SALES_COLS)}) > 1
           THEN 'pedido_id repetido' END) AS reject_reason
  FROM s_typed)""",
    f"s_clean AS (SELECT {', '.join(SALES_COLS)} FROM s_flag WHERE reject_reason = '')",
    "s_rej AS (SELECT * FROM s_flag WHERE reject_reason <> '')",
]

EV_TEXT = ("state", "center", "dest_city", "carrier", "tracking_no", "incident", "note")
_NULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in EV_RAW_COLS)
_W = "(PARTITION BY order_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
SILVER_EVENT_CTES = [
    "e_dedup AS (SELECT DISTINCT * FROM events_raw)",
    f"e_nores AS (SELECT {', '.join(EV_RAW_COLS)} FROM e_dedup)",
    f"""e_rank AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {_NULLS}, {_all_nulls_first(EV_RAW_COLS)}) AS rn
  FROM e_nores)""",
    f"e_keep AS (SELECT {', '.join(EV_RAW_COLS)} FROM e_rank WHERE rn = 1)",
    "e_typed AS (SELECT " + ", ".join(
        (_clean(c) + f" AS {c}") if c in EV_TEXT else
        ("try_cast(event_ts_txt AS TIMESTAMP) AS event_ts" if c == "event_ts_txt" else
         ("try_cast(promised_ts_txt AS TIMESTAMP) AS promised_ts" if c == "promised_ts_txt" else c))
        for c in EV_RAW_COLS) + " FROM e_keep)",
    f"""e_rec AS (
  SELECT event_id, order_id, event_ts, state,
    center IS NULL AS nul_center, dest_city IS NULL AS nul_dest, promised_ts IS NULL AS nul_promised,
    coalesce(state IN {TRANSPORT}, false) AND carrier IS NULL AS nul_carrier,
    coalesce(state IN {TRANSPORT}, false) AND tracking_no IS NULL AS nul_tracking,
    CASE WHEN order_id IS NULL THEN NULL ELSE first_value(center IGNORE NULLS) OVER {_W} END AS center,
    CASE WHEN order_id IS NULL THEN NULL ELSE first_value(dest_city IGNORE NULLS) OVER {_W} END AS dest_city,
    CASE WHEN coalesce(state IN {TRANSPORT}, false) AND carrier IS NULL AND order_id IS NOT NULL
         THEN first_value(carrier IGNORE NULLS) OVER {_W} ELSE carrier END AS carrier,
    CASE WHEN coalesce(state IN {TRANSPORT}, false) AND tracking_no IS NULL AND order_id IS NOT NULL
         THEN first_value(tracking_no IGNORE NULLS) OVER {_W} ELSE tracking_no END AS tracking_no,
    CASE WHEN order_id IS NULL THEN NULL ELSE first_value(promised_ts IGNORE NULLS) OVER {_W} END AS promised_ts,
    stage_hours, ship_cost,
    coalesce(incident, 'Sin incidencia') AS incident,
    coalesce(note, 'Sin observación') AS note
  FROM e_typed)""",
    """e_flag AS (
  SELECT *, concat_ws('; ',
      CASE WHEN order_id NOT IN (SELECT order_id FROM s_clean WHERE order_id IS NOT NULL) OR order_id IS NULL
           THEN 'pedido sin venta válida' END,
      CASE WHEN NOT coalesce(dest_city IN (SELECT city FROM coverage), false)
           THEN 'ciudad_destino fuera de cobertura' END) AS reject_reason
  FROM e_rec)""",
    f"e_clean AS (SELECT {', '.join(EV_COLS)} FROM e_flag WHERE reject_reason = '')",
    f"e_rej AS (SELECT {', '.join(EV_COLS)}, reject_reason FROM e_flag WHERE reject_reason <> '')",
]
SILVER_CTES = SILVER_SALES_CTES + SILVER_EVENT_CTES


def _inc(source, level, key, order, kind, action, detail="''", frm="", where="") -> str:
    return (f"SELECT '{source}' AS source, '{level}' AS level, CAST({key} AS VARCHAR) AS key, "
            f"CAST({order} AS VARCHAR) AS order_id, {kind} AS kind, '{action}' AS action, "
            f"CAST({detail} AS VARCHAR) AS detail FROM {frm}" + (f" WHERE {where}" if where else ""))


INCIDENT_CTES = [
    "e_dupcount AS (SELECT event_id, order_id, count(*) AS n FROM events_raw GROUP BY "
    + ", ".join(EV_RAW_COLS + ("unnamed_13",)) + " HAVING count(*) > 1)",
    "inc_dup AS (" + _inc("logistica", "evento", "event_id", "order_id", "'Fila duplicada'", "Eliminada",
                          frm="e_dupcount, range(2, n + 1)") + ")",
    "inc_res AS (SELECT 'logistica' AS source, 'columna' AS level, 'unnamed_13' AS key, '' AS order_id, "
    "'Columna residual del Excel' AS kind, 'Eliminada' AS action, "
    "CAST(count(unnamed_13) AS VARCHAR) || ' celda(s) con datos' AS detail FROM e_dedup)",
    "inc_conf AS (" + _inc("logistica", "evento", "event_id", "order_id",
                           "'evento_id repetido con contenido distinto'", "Se conservó la versión más completa",
                           frm="e_rank", where="rn > 1") + ")",
    "inc_ev AS (" + " UNION ALL ".join([
        _inc("logistica", "evento", "event_id", "order_id", "'center nulo'", "Recuperado del mismo pedido",
             frm="e_rec", where="nul_center"),
        _inc("logistica", "evento", "event_id", "order_id", "'dest_city nulo'", "Recuperado del mismo pedido",
             frm="e_rec", where="nul_dest"),
        _inc("logistica", "evento", "event_id", "order_id", "'promised_ts nulo'", "Recuperado del mismo pedido",
             frm="e_rec", where="nul_promised"),
        _inc("logistica", "evento", "event_id", "order_id", "'carrier nulo en estado de transporte'",
             "Completado con el valor del pedido", frm="e_rec", where="nul_carrier"),
        _inc("logistica", "evento", "event_id", "order_id", "'tracking_no nulo en estado de transporte'",
             "Completado con el valor del pedido", frm="e_rec", where="nul_tracking"),
        _inc("logistica", "evento", "event_id", "order_id", "'fecha_evento nula'",
             "Se mantiene nulo (no recuperable)", detail="state", frm="e_rec", where="event_ts IS NULL"),
    ]) + ")",
    "inc_rej AS (" + _inc("logistica", "evento", "event_id", "order_id", "'Registro rechazado'",
                          "Enviado a cuarentena", detail="reject_reason", frm="e_rej") + ")",
    "inc_sales AS (" + _inc("ventas", "venta", "sale_id", "order_id", "'Registro rechazado'",
                            "Enviado a cuarentena", detail="reject_reason", frm="s_rej") + ")",
    "all_states AS (SELECT DISTINCT state FROM e_clean)",
    """e_missing AS (
  SELECT o.order_id, string_agg(a.state, ', ' ORDER BY a.state) AS missing
  FROM (SELECT DISTINCT order_id FROM e_clean WHERE order_id IS NOT NULL) o CROSS JOIN all_states a
  WHERE NOT EXISTS (SELECT 1 FROM e_clean e WHERE e.order_id = o.order_id AND e.state = a.state)
  GROUP BY o.order_id)""",
    "inc_missing AS (" + _inc("logistica", "pedido", "order_id", "order_id", "'Trazabilidad incompleta'",
                              "Marcado en Gold", detail="'Faltan: ' || missing", frm="e_missing") + ")",
    f"""e_undated AS (
  SELECT order_id FROM e_clean WHERE state = {DELIVERED} AND order_id IS NOT NULL
  GROUP BY order_id HAVING count(event_ts) = 0)""",
    "inc_undated AS (" + _inc("logistica", "pedido", "order_id", "order_id", "'Evento Entregado sin fecha'",
                              "Sin fecha de entrega en Gold", frm="e_undated") + ")",
    """shared_trk AS (
  SELECT tracking_no FROM e_clean WHERE tracking_no IS NOT NULL
  GROUP BY tracking_no HAVING count(DISTINCT order_id) > 1)""",
    """shared_pairs AS (
  SELECT DISTINCT e.tracking_no, e.order_id FROM e_clean e JOIN shared_trk t ON t.tracking_no = e.tracking_no)""",
    "inc_shared AS (" + _inc("logistica", "pedido", "order_id", "order_id",
                             "'numero_guia compartido entre pedidos'", "Marcado en Gold", detail="tracking_no",
                             frm="shared_pairs") + ")",
    """incidents AS (
  SELECT * FROM inc_sales UNION ALL SELECT * FROM inc_dup UNION ALL SELECT * FROM inc_res
  UNION ALL SELECT * FROM inc_conf UNION ALL SELECT * FROM inc_ev UNION ALL SELECT * FROM inc_rej
  UNION ALL SELECT * FROM inc_missing UNION ALL SELECT * FROM inc_undated UNION ALL SELECT * FROM inc_shared)""",
]


def silver(*ctes: str, select: str) -> str:
    return with_fixtures(*SILVER_CTES, *INCIDENT_CTES, *ctes, select=select)


def c_queries() -> dict[str, str]:
    q = {}
    q["dedup_exact"] = with_fixtures(select="SELECT DISTINCT * FROM events_raw")
    q["incidents_duplicates"] = silver(select="SELECT * FROM inc_dup")
    q["drop_residual"] = silver(select="SELECT * FROM inc_res")
    q["resolve_key_conflicts"] = silver(select="SELECT * FROM e_keep")
    q["coerce_dates"] = silver(select="SELECT event_id, event_ts, promised_ts FROM e_typed")
    q["coerce_rating"] = silver(select="SELECT sale_id, order_id, pay_method, rating FROM s_typed")
    q["normalize_text"] = silver(select="SELECT sale_id, pay_method, city, channel, category, product, store_id "
                                        "FROM s_typed")
    q["recover_group_constant"] = silver(select="SELECT event_id, order_id, center, dest_city, promised_ts FROM e_rec")
    q["fill_in_transport_states"] = silver(select="SELECT event_id, state, carrier, tracking_no FROM e_rec")
    q["explicit_null_category"] = silver(select="SELECT event_id, incident, note FROM e_rec")
    q["silver_sales"] = silver(select="SELECT * FROM s_clean")
    q["quarantine_sales"] = silver(select="SELECT * EXCLUDE (reject_reason), reject_reason FROM s_rej")
    q["quarantine_reason_counts"] = silver(select="""
SELECT 'ventas' AS source, reject_reason, count(*) AS rows FROM s_rej GROUP BY reject_reason
UNION ALL
SELECT 'logistica' AS source, reject_reason, count(*) AS rows FROM e_rej GROUP BY reject_reason""")
    q["silver_events"] = silver(select="SELECT * FROM e_clean")
    q["quarantine_events"] = silver(select="SELECT * FROM e_rej")
    q["incident_log"] = silver(select="SELECT * FROM incidents")
    q["recovery_outcomes"] = silver(select=_union([
        f"SELECT '{c}{kind}' AS kind, {c} IS NOT NULL AS resolved, count(*) AS incidents FROM e_rec WHERE {flag} GROUP BY ALL"
        for c, flag, kind in (("center", "nul_center", " nulo"), ("dest_city", "nul_dest", " nulo"), ("promised_ts", "nul_promised", " nulo"),
                              ("carrier", "nul_carrier", " nulo en estado de transporte"), ("tracking_no", "nul_tracking", " nulo en estado de transporte"))]))
    q["missing_states"] = silver(select="SELECT * FROM inc_missing")
    q["delivered_without_date"] = silver(select="SELECT * FROM inc_undated")
    q["shared_tracking_orders"] = silver(select="SELECT tracking_no, order_id FROM shared_pairs")
    q["incident_summary"] = silver(select="SELECT level, kind, action, count(*) AS incidents FROM incidents "
                                          "GROUP BY level, kind, action")
    return q


# ------------------------------------------------------------------ D (Gold)
def _days(a: str, b: str) -> str:
    return r2(f"date_diff('microsecond', {a}, {b}) / 86400000000.0")


GOLD_CTES = [
    """summary AS (
  SELECT order_id, count(event_id) AS n_events, count(DISTINCT state) AS n_states,
    arg_max(state, event_id) FILTER (WHERE state IS NOT NULL) AS final_state,
    max(event_ts) AS last_event_ts,
    arg_min(promised_ts, event_id) FILTER (WHERE promised_ts IS NOT NULL) AS promised_ts,
    arg_min(center, event_id) FILTER (WHERE center IS NOT NULL) AS center,
    arg_min(dest_city, event_id) FILTER (WHERE dest_city IS NOT NULL) AS dest_city,
    arg_min(carrier, event_id) FILTER (WHERE carrier IS NOT NULL) AS carrier,
    arg_min(tracking_no, event_id) FILTER (WHERE tracking_no IS NOT NULL) AS tracking_no,
    arg_min(ship_cost, event_id) FILTER (WHERE ship_cost IS NOT NULL) AS ship_cost,
    CAST(coalesce(sum(stage_hours), 0) AS DOUBLE) AS total_hours,
    count(*) FILTER (WHERE incident <> 'Sin incidencia') AS n_incidents,
    max(event_ts) FILTER (WHERE state = 'R') AS delivery_ts,
    bool_or(state = 'R') AS has_delivered
  FROM e_clean WHERE order_id IS NOT NULL GROUP BY order_id)""",
    """summary_flags AS (
  SELECT s.*, s.n_states = (SELECT count(DISTINCT state) FROM e_clean) AS trace_complete,
         coalesce(s.tracking_no IN (SELECT tracking_no FROM shared_trk), false) AS tracking_shared
  FROM summary s)""",
    f"""g_orders AS (
  SELECT v.*, f.n_events, f.n_states, f.final_state, f.last_event_ts, f.promised_ts, f.center, f.dest_city,
    f.carrier, f.tracking_no, f.ship_cost, f.total_hours, f.n_incidents, f.delivery_ts,
    f.trace_complete, f.tracking_shared,
    {_days('f.promised_ts', 'f.delivery_ts')} AS delay_days,
    {_days('f.promised_ts', 'f.delivery_ts')} > 0 AS late,
    coalesce(f.has_delivered, false) AS delivered,
    {_days('v.sale_ts', 'f.delivery_ts')} AS cycle_days,
    {_days('v.sale_ts', 'f.promised_ts')} AS promised_days,
    strftime(v.sale_ts, '%Y-%m') AS month
  FROM s_clean v LEFT JOIN summary_flags f ON f.order_id = v.order_id)""",
    "g_inc AS (SELECT *, coalesce(n_incidents > 0, false) AS with_incident FROM g_orders)",
]


def gold(*ctes: str, select: str) -> str:
    return with_fixtures(*SILVER_CTES, *INCIDENT_CTES, *GOLD_CTES, *ctes, select=select)


def _pct(flag: str) -> str:
    return r2(f"avg(CAST({flag} AS DOUBLE)) * 100")


def d_queries() -> dict[str, str]:
    q = {}
    sales_no_amounts = [c for c in SALES_COLS if c not in ("unit_price", "gross", "discount", "net")]
    q["gold_events"] = gold(select=f"""
SELECT {', '.join('v.' + c for c in sales_no_amounts)},
       {', '.join('e.' + c for c in EV_COLS if c != 'order_id')}
FROM s_clean v LEFT JOIN e_clean e ON e.order_id = v.order_id""")
    q["order_summary"] = gold(select="SELECT * EXCLUDE (has_delivered) FROM summary")
    q["order_flags"] = gold(select="SELECT order_id, tracking_no, n_states, trace_complete, tracking_shared "
                                   "FROM summary_flags")
    q["gold_orders"] = gold(select="SELECT * FROM g_orders")
    q["delivery_delay"] = gold(select="SELECT order_id, promised_ts, delivery_ts, delay_days, late FROM g_orders")
    q["delivery_indicators"] = gold(select="SELECT order_id, delivered, delivery_ts FROM g_orders")
    q["cycle_days"] = gold(select="SELECT order_id, cycle_days, promised_days, month FROM g_orders")
    q["kpi_monthly"] = gold(select=f"""
SELECT month, count(order_id) AS orders, count(DISTINCT customer_id) AS customers,
  CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(gross) AS DECIMAL(38,2)) AS gross,
  CAST(sum(discount) AS DECIMAL(38,2)) AS discount, CAST(sum(net) AS DECIMAL(38,2)) AS net,
  {r2('avg(net)')} AS avg_ticket, CAST(coalesce(sum(ship_cost), 0) AS BIGINT) AS ship_cost_total,
  {_pct('late')} AS pct_late, {r2('avg(CAST(delay_days AS DECIMAL(18,2)))')} AS avg_delay_days,
  {r2('quantile_cont(cycle_days, 0.5)')} AS median_cycle_days,
  {_pct('with_incident')} AS pct_orders_with_incident, {r2('avg(rating)')} AS avg_rating
FROM g_inc WHERE month IS NOT NULL GROUP BY month""")
    q["carrier_performance"] = gold(select=f"""
SELECT carrier, count(order_id) AS orders, {_pct('late')} AS pct_late,
  {r2('avg(CAST(delay_days AS DECIMAL(18,2))) FILTER (WHERE late)')} AS avg_delay_late,
  {r2('quantile_cont(cycle_days, 0.5)')} AS median_cycle_days,
  {r2('quantile_cont(total_hours, 0.5)')} AS median_total_hours,
  {r2('avg(ship_cost)')} AS avg_ship_cost, {_pct('with_incident')} AS pct_orders_with_incident,
  {r2('avg(rating)')} AS avg_rating
FROM g_inc WHERE carrier IS NOT NULL GROUP BY carrier""")
    q["city_channel_sales"] = gold(select=f"""
SELECT city, channel, count(order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
  CAST(sum(net) AS DECIMAL(38,2)) AS net, {r2('avg(net)')} AS avg_ticket, {_pct('late')} AS pct_late,
  {r2('CAST(sum(net) AS DOUBLE) / (SELECT CAST(sum(net) AS DOUBLE) FROM g_orders) * 100')} AS pct_of_total_net
FROM g_orders WHERE city IS NOT NULL AND channel IS NOT NULL GROUP BY city, channel""")
    q["delivery_kpis"] = gold(select=f"""
SELECT count(*) AS orders, count(late) AS dated_deliveries, count(*) FILTER (WHERE late) AS late_deliveries,
  count(*) FILTER (WHERE delivery_ts IS NULL) AS undated,
  count(*) FILTER (WHERE delivery_ts IS NULL AND NOT delivered) AS undated_no_delivered_event,
  count(*) FILTER (WHERE delivery_ts IS NULL AND delivered) AS undated_delivered_event,
  count(*) FILTER (WHERE delivered) AS delivered_orders,
  {r2('avg(CAST(delay_days AS DECIMAL(18,2))) FILTER (WHERE late)')} AS avg_delay_late,
  max(delay_days) AS max_delay_days,
  {r2('quantile_cont(cycle_days, 0.5)')} AS median_cycle_days,
  {r2('quantile_cont(promised_days, 0.5)')} AS median_promised_days,
  count(*) FILTER (WHERE NOT coalesce(trace_complete, false)) AS incomplete_traces,
  count(*) FILTER (WHERE n_events IS NULL) AS orders_without_events,
  (SELECT count(*) FROM g_orders o WHERE NOT EXISTS
    (SELECT 1 FROM e_clean e WHERE e.order_id = o.order_id AND e.state = 'N')) AS orders_without_first_state
FROM g_orders""")
    q["late_rate_by_month"] = gold(select=f"""
SELECT month, count(late) AS dated_deliveries, {_pct('late')} AS pct_late
FROM g_orders WHERE month IS NOT NULL GROUP BY month""")
    q["delay_distribution"] = gold(select=f"""
SELECT count(delay_days) AS count, {r2('avg(CAST(delay_days AS DECIMAL(18,2)))')} AS mean, {r2('stddev_samp(delay_days)')} AS std,
  min(delay_days) AS min, {r2('quantile_cont(delay_days, 0.25)')} AS p25,
  {r2('quantile_cont(delay_days, 0.5)')} AS median, {r2('quantile_cont(delay_days, 0.75)')} AS p75,
  max(delay_days) AS max
FROM g_orders""")
    return q


# ------------------------------------------------------------------ E (rules)
def _dups(c: str) -> str:
    return f"(count(*) - count(DISTINCT {c}) - CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 1 ELSE 0 END)"


MART_CTES = [
    "m_month AS (SELECT month, count(order_id) AS orders, sum(net) AS net FROM g_orders "
    "WHERE month IS NOT NULL GROUP BY month)",
    "m_carrier AS (SELECT carrier, count(order_id) AS orders FROM g_orders WHERE carrier IS NOT NULL GROUP BY carrier)",
    "m_cc AS (SELECT city, channel, count(order_id) AS orders, sum(net) AS net FROM g_orders "
    "WHERE city IS NOT NULL AND channel IS NOT NULL GROUP BY city, channel)",
    "g_events AS (SELECT v.order_id, e.event_id FROM s_clean v LEFT JOIN e_clean e ON e.order_id = v.order_id)",
]


def _rule(layer, rid, text, viol, ok=None) -> str:
    ok = ok or f"({viol}) = 0"
    return (f"SELECT '{layer}' AS layer, '{rid}' AS rule_id, '{text}' AS rule, "
            f"CAST({viol} AS BIGINT) AS violations, {ok} AS passed")


def e_queries() -> dict[str, str]:
    q = {}
    share_s = "((SELECT count(*) FROM s_rej) * 100.0 / (SELECT count(*) FROM sales_raw))"
    share_e = "((SELECT count(*) FROM e_rej) * 100.0 / (SELECT count(*) FROM events_raw))"
    oc_s = ("(SELECT count(*) FROM (SELECT DISTINCT city FROM s_clean WHERE city IS NOT NULL) x "
            "WHERE city NOT IN (SELECT city FROM coverage))")
    oc_e = ("(SELECT count(*) FROM (SELECT DISTINCT dest_city FROM e_clean WHERE dest_city IS NOT NULL) x "
            "WHERE dest_city NOT IN (SELECT city FROM coverage))")
    ident = f"(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM e_clean GROUP BY {', '.join(EV_COLS)}))"
    orphans = ("(SELECT count(*) FROM e_clean e WHERE NOT EXISTS "
               "(SELECT 1 FROM s_clean s WHERE s.order_id = e.order_id))")
    tr = f"coalesce(state IN {TRANSPORT}, false)"
    sil = [
        _rule("silver_sales", "R1", "sale_id unique", f"(SELECT {_dups('sale_id')} FROM s_clean)"),
        _rule("silver_sales", "R2", "order_id unique", f"(SELECT {_dups('order_id')} FROM s_clean)"),
        _rule("silver_sales", "R3", "sale_ts is a timestamp without nulls",
              "(SELECT count(*) FILTER (WHERE sale_ts IS NULL) FROM s_clean)"),
        _rule("silver_sales", "R4", "rating between 1 and 5 (or null)",
              "(SELECT count(*) FILTER (WHERE rating IS NOT NULL AND NOT coalesce(rating BETWEEN 1 AND 5, false)) "
              "FROM s_clean)"),
        _rule("silver_sales", "R5", "amounts not negative",
              "(SELECT count(*) FILTER (WHERE unit_price < 0) + count(*) FILTER (WHERE gross < 0) + "
              "count(*) FILTER (WHERE discount < 0) + count(*) FILTER (WHERE net < 0) FROM s_clean)"),
        _rule("silver_sales", "R6", "cities inside coverage", oc_s),
        _rule("silver_events", "R7", "event_id unique", f"(SELECT {_dups('event_id')} FROM e_clean)"),
        _rule("silver_events", "R8", "no identical rows", ident),
        _rule("silver_events", "R9", "no residual columns", "0"),
        _rule("silver_events", "R10", "date columns are timestamps", "0"),
        _rule("silver_events", "R11", "center without nulls",
              "(SELECT count(*) FILTER (WHERE center IS NULL) FROM e_clean)"),
        _rule("silver_events", "R12", "dest_city without nulls",
              "(SELECT count(*) FILTER (WHERE dest_city IS NULL) FROM e_clean)"),
        _rule("silver_events", "R13", "promised_ts without nulls",
              "(SELECT count(*) FILTER (WHERE promised_ts IS NULL) FROM e_clean)"),
        _rule("silver_events", "R14", "carrier present in transport states",
              f"(SELECT count(*) FILTER (WHERE {tr} AND carrier IS NULL) FROM e_clean)"),
        _rule("silver_events", "R15", "carrier absent before dispatch",
              f"(SELECT count(*) FILTER (WHERE NOT {tr} AND carrier IS NOT NULL) FROM e_clean)"),
        _rule("silver_events", "R16", "tracking_no present in transport states",
              f"(SELECT count(*) FILTER (WHERE {tr} AND tracking_no IS NULL) FROM e_clean)"),
        _rule("silver_events", "R17", "tracking_no absent before dispatch",
              f"(SELECT count(*) FILTER (WHERE NOT {tr} AND tracking_no IS NOT NULL) FROM e_clean)"),
        _rule("silver_events", "R18", "destination cities inside coverage", oc_e),
        _rule("silver_events", "R19", "every event order exists in sales", orphans),
        _rule("silver_events", "R20", "sales quarantine share within limit", "(SELECT count(*) FROM s_rej)",
              f"{share_s} <= 5.0"),
        _rule("silver_events", "R21", "events quarantine share within limit", "(SELECT count(*) FROM e_rej)",
              f"{share_e} <= 5.0"),
    ]
    sil = [x.replace("'silver_events' AS layer, 'R20'", "'silver_events' AS layer, 'R20'") for x in sil]
    q["silver_rules"] = gold(select="\nUNION ALL\n".join(sil))
    n_g = "(SELECT count(*) FROM g_orders)"
    net_g = "(SELECT coalesce(sum(net), 0) FROM g_orders)"
    gl = [
        _rule("gold", "R22", "one row per Silver sale", f"abs({n_g} - (SELECT count(*) FROM s_clean))"),
        _rule("gold", "R23", "order_id unique", f"(SELECT {_dups('order_id')} FROM g_orders)"),
        _rule("gold", "R24", "net equals Silver net",
              f"CASE WHEN abs({net_g} - (SELECT coalesce(sum(net), 0) FROM s_clean)) >= 1 THEN 1 ELSE 0 END"),
        _rule("gold", "R25", "every order has an event summary",
              "(SELECT count(*) FILTER (WHERE n_events IS NULL) FROM g_orders)"),
        _rule("gold", "R26", "ship_cost without nulls",
              "(SELECT count(*) FILTER (WHERE ship_cost IS NULL) FROM g_orders)"),
        _rule("gold", "R27", "one row per Silver event",
              "abs((SELECT count(*) FROM g_events) - (SELECT count(*) FROM e_clean))"),
        _rule("gold", "R28", "no sale amounts in the event table", "0"),
    ]
    marts = [
        _rule("gold", "R29", "kpi_monthly: orders reconcile", f"abs((SELECT coalesce(sum(orders), 0) FROM m_month) - {n_g})"),
        _rule("gold", "R30", "kpi_monthly: net reconciles",
              f"CASE WHEN abs((SELECT coalesce(sum(net), 0) FROM m_month) - {net_g}) >= 1 THEN 1 ELSE 0 END"),
        _rule("gold", "R31", "carrier_performance: orders reconcile",
              f"abs((SELECT coalesce(sum(orders), 0) FROM m_carrier) - {n_g})"),
        _rule("gold", "R32", "city_channel_sales: orders reconcile",
              f"abs((SELECT coalesce(sum(orders), 0) FROM m_cc) - {n_g})"),
        _rule("gold", "R33", "city_channel_sales: net reconciles",
              f"CASE WHEN abs((SELECT coalesce(sum(net), 0) FROM m_cc) - {net_g}) >= 1 THEN 1 ELSE 0 END"),
    ]
    q["gold_rules"] = gold(*MART_CTES, select="\nUNION ALL\n".join(gl + marts))
    q["reconcile_marts"] = gold(*MART_CTES, select="\nUNION ALL\n".join(marts))
    no_events = "(SELECT count(*) FROM s_clean v WHERE NOT EXISTS (SELECT 1 FROM e_clean e WHERE e.order_id = v.order_id))"
    no_carrier = ("(SELECT count(*) FROM s_clean v WHERE NOT EXISTS (SELECT 1 FROM e_clean e WHERE e.order_id = v.order_id "
                  "AND e.carrier IS NOT NULL))")
    tolerated = ("R25", "R26")
    expected = {"R27": f"abs((SELECT count(*) FROM g_events) - (SELECT count(*) FROM e_clean) - {no_events})",
                "R31": f"abs((SELECT coalesce(sum(orders), 0) FROM m_carrier) - {n_g} + {no_carrier})"}
    rows = [f"SELECT layer, rule_id, rule, CASE rule_id " + " ".join(f"WHEN '{r}' THEN CAST({x} AS BIGINT)" for r, x in expected.items())
            + f" ELSE violations END AS violations, CASE rule_id " + " ".join(f"WHEN '{r}' THEN {x} = 0" for r, x in expected.items())
            + " " + " ".join(f"WHEN '{r}' THEN violations * 100.0 <= 10.0 * {n_g}" for r in tolerated)
            + " ELSE passed END AS passed FROM (" + "\nUNION ALL\n".join(gl + marts) + ")"]
    q["gold_rules_expected_gaps"] = gold(*MART_CTES, select=rows[0])
    outside = "SELECT '{r}' AS rule_id, {c} AS value FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT city FROM coverage)"
    offenders = [
        *[f"SELECT '{r}' AS rule_id, CAST({k} AS VARCHAR) AS value FROM {t} GROUP BY {k} HAVING count(*) > 1"
          for r, k, t in (("R1", "sale_id", "s_clean"), ("R2", "order_id", "s_clean"), ("R7", "event_id", "e_clean"), ("R23", "order_id", "g_orders"))],
        f"SELECT 'R8', CAST(event_id AS VARCHAR) FROM e_clean GROUP BY {', '.join(EV_COLS)} HAVING count(*) > 1",
        *[f"SELECT '{r}', CAST(sale_id AS VARCHAR) FROM s_clean WHERE {w}" for r, w in (
            ("R3", "sale_ts IS NULL"), ("R4", "rating NOT BETWEEN 1 AND 5"), ("R5", "unit_price < 0 OR gross < 0 OR discount < 0 OR net < 0"))],
        *[f"SELECT '{r}', CAST(event_id AS VARCHAR) FROM e_clean WHERE {w}" for r, w in (
            ("R11", "center IS NULL"), ("R12", "dest_city IS NULL"), ("R13", "promised_ts IS NULL"),
            ("R14", f"{tr} AND carrier IS NULL"), ("R15", f"NOT {tr} AND carrier IS NOT NULL"),
            ("R16", f"{tr} AND tracking_no IS NULL"), ("R17", f"NOT {tr} AND tracking_no IS NOT NULL"))],
        outside.format(r="R6", c="city", t="s_clean"), outside.format(r="R18", c="dest_city", t="e_clean"),
        "SELECT 'R19', CAST(order_id AS VARCHAR) FROM e_clean e WHERE NOT EXISTS (SELECT 1 FROM s_clean s WHERE s.order_id = e.order_id)",
        *[f"SELECT '{r}', CAST(order_id AS VARCHAR) FROM g_orders WHERE {c} IS NULL" for r, c in (("R25", "n_events"), ("R26", "ship_cost"))]]
    what = ("R1 repeated, R2 repeated, R3 null, R4 out of range, R5 negative, R6 outside coverage, R7 repeated, R8 repeated, R9 residual, "
            "R10 not a timestamp, R11 null, R12 null, R13 null, R14 null, R15 filled, R16 null, R17 filled, R18 outside coverage, "
            "R19 orphan events, R20 rejected, R21 rejected, R22 difference, R23 repeated, R24 difference, R25 without events, R26 null, "
            "R27 difference, R28 amounts, R29 difference, R30 difference, R31 difference, R32 difference, R33 difference")
    words = ", ".join("('{}', '{}')".format(*w.split(" ", 1)) for w in what.split(", "))
    q["rule_details"] = gold(*MART_CTES, "all_rules AS (" + "\nUNION ALL\n".join(sil + gl + marts) + ")",
                             "offenders AS (SELECT DISTINCT * FROM (" + "\nUNION ALL\n".join(offenders) + ") WHERE value IS NOT NULL)",
                             """named AS (
  SELECT rule_id, string_agg(value, ', ' ORDER BY value) FILTER (WHERE place <= 5) AS few, count(*) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY value) AS place FROM offenders) GROUP BY rule_id)""",
                             f"words(rule_id, word) AS (VALUES {words})", select="""
SELECT layer, r.rule_id, rule, violations, passed, violations || ' ' || word
  || coalesce(': ' || few || CASE WHEN n > 5 THEN ' and ' || (n - 5) || ' more' ELSE '' END, '') AS detail
FROM all_rules r JOIN words USING (rule_id) LEFT JOIN named USING (rule_id)""")
    q["quarantine_share"] = gold(select=f"""
SELECT 'ventas' AS source, (SELECT count(*) FROM s_rej) AS rejected, (SELECT count(*) FROM sales_raw) AS raw_rows,
       {r2(share_s)} AS pct, {share_s} <= 5.0 AS passed
UNION ALL
SELECT 'logistica', (SELECT count(*) FROM e_rej), (SELECT count(*) FROM events_raw), {r2(share_e)}, {share_e} <= 5.0""")
    return q


# ------------------------------------------------------------------ B (profiling / checks)
RAW_TYPES = {
    "sales": [("sale_id", "bigint"), ("order_id", "bigint"), ("sale_ts", "timestamp_ntz"),
              ("customer_id", "bigint"), ("city", "string"), ("channel", "string"), ("store_id", "string"),
              ("category", "string"), ("product", "string"), ("pay_method", "string"), ("quantity", "int"),
              ("unit_price", "decimal(18,2)"), ("discount_rate", "decimal(5,2)"), ("gross", "decimal(18,2)"),
              ("discount", "decimal(18,2)"), ("net", "decimal(18,2)"), ("rating", "int")],
    "events": [("event_id", "bigint"), ("order_id", "bigint"), ("event_ts_txt", "string"), ("state", "string"),
               ("center", "string"), ("dest_city", "string"), ("carrier", "string"), ("tracking_no", "string"),
               ("promised_ts_txt", "string"), ("stage_hours", "double"), ("ship_cost", "int"),
               ("incident", "string"), ("note", "string"), ("unnamed_13", "string")],
}
RAW_VIEW = {"sales": "sales_raw", "events": "events_raw"}


#: Expected role of each column, stated here and not taken from the code under test.
ROLES = {
    "sales": {"sale_id": "identifier", "order_id": "identifier", "sale_ts": "date", "customer_id": "identifier",
              "city": "categorical", "channel": "categorical", "store_id": "identifier", "category": "categorical",
              "product": "categorical", "pay_method": "categorical", "quantity": "numeric", "unit_price": "amount",
              "discount_rate": "numeric", "gross": "amount", "discount": "amount", "net": "amount",
              "rating": "ordinal"},
    "events": {"event_id": "identifier", "order_id": "identifier", "event_ts_txt": "date", "state": "categorical",
               "center": "categorical", "dest_city": "categorical", "carrier": "categorical",
               "tracking_no": "identifier", "promised_ts_txt": "date", "stage_hours": "duration",
               "ship_cost": "amount", "incident": "categorical", "note": "categorical", "unnamed_13": "residual"},
}
#: Expected verdict on the type of each column whose type is not plainly right, then by role.
TYPE_VERDICTS = {"event_ts_txt": "REVIEW: date stored as string, convert to timestamp",
                 "promised_ts_txt": "REVIEW: date stored as string, convert to timestamp",
                 "unnamed_13": "REVIEW: drop (not part of the data model)",
                 "sale_id": "OK: integer key", "order_id": "OK: integer key", "customer_id": "OK: integer key",
                 "event_id": "OK: integer key", "store_id": "OK: text key", "tracking_no": "OK: text key",
                 "sale_ts": "OK (timestamp)", "rating": "OK (integer scale)",
                 "stage_hours": "OK: duration in hours", "quantity": "OK (numeric)", "discount_rate": "OK (numeric)",
                 **dict.fromkeys(("unit_price", "gross", "discount", "net", "ship_cost"), "OK (numeric amount)")}


def _cols_role(tbl: str, *wanted: str) -> list[str]:
    return [c for c, _ in RAW_TYPES[tbl] if ROLES[tbl][c] in wanted]


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def b_queries() -> dict[str, str]:
    q = {}
    parts = []
    for tbl, view in RAW_VIEW.items():
        for c in _cols_role(tbl, "date"):
            x = c if dict(RAW_TYPES[tbl])[c].startswith("timestamp") else f"try_cast({c} AS TIMESTAMP)"
            parts.append(f"SELECT '{tbl}' AS tbl, '{c}' AS column, min({x}) AS min_ts, max({x}) AS max_ts FROM {view}")
    q["profile_date_range"] = with_fixtures(select=_union(parts))
    parts = []
    for tbl, view in RAW_VIEW.items():
        for c, t in RAW_TYPES[tbl]:
            parts.append(f"SELECT '{tbl}' AS tbl, '{c}' AS column, '{t}' AS type, count({c}) AS non_null, "
                         f"count(*) - count({c}) AS nulls, {r2(f'(count(*) - count({c})) * 100.0 / count(*)')} "
                         f"AS pct_null, '{ROLES[tbl][c]}' AS role FROM {view}")
    q["profile_structure"] = with_fixtures(select=_union(parts))
    q["profile_nulls"] = with_fixtures(select=f'SELECT tbl, "column", nulls, pct_null FROM ({_union(parts)}) x')
    parts = []
    for tbl, view in RAW_VIEW.items():
        for c, t in RAW_TYPES[tbl]:
            role = ROLES[tbl][c]
            d, nn = f"count(DISTINCT CAST({c} AS VARCHAR))", f"count({c})"
            if role == "identifier":
                verdict = (f"CASE WHEN {d} = {nn} THEN 'unique identifier' WHEN {d} >= {nn} * 0.4 THEN "
                           "'identifier with repeats (high cardinality)' ELSE 'repeating key' END")
            elif role in ("categorical", "ordinal"):
                verdict = (f"CASE WHEN {d} <= 10 THEN 'low cardinality' WHEN {d} <= 50 THEN 'medium cardinality' "
                           "ELSE 'high cardinality' END")
            elif role == "residual":
                verdict = "'no useful information'"
            elif role == "date":
                verdict = f"CASE WHEN {d} > {nn} * 0.5 THEN 'date (almost unique per row)' ELSE 'repeating date' END"
            else:
                verdict = f"CASE WHEN {d} <= 12 THEN 'discrete numeric' ELSE 'continuous numeric' END"
            parts.append(f"SELECT '{tbl}' AS tbl, '{c}' AS column, '{role}' AS role, {d} AS distinct, "
                         f"{nn} AS non_null, {r2(f'{d} * 100.0 / count(*)')} AS pct_of_rows, "
                         f"{r2(f'CAST({nn} AS DOUBLE) / nullif({d}, 0)', 1)} AS rows_per_value, "
                         f"{verdict} AS verdict FROM {view}")
    q["profile_cardinality"] = with_fixtures(select=_union(parts))

    def num(tbl, view, cols):
        out = []
        for c in cols:
            x = f"CAST({c} AS DOUBLE)"
            out.append(f"SELECT '{tbl}' AS tbl, '{c}' AS column, count({x}) AS count, {r2(f'avg({x})')} AS mean, "
                       f"{r2(f'stddev_samp({x})')} AS std, min({x}) AS min, "
                       f"{r2(f'quantile_cont({x}, 0.25)')} AS p25, {r2(f'quantile_cont({x}, 0.5)')} AS median, "
                       f"{r2(f'quantile_cont({x}, 0.75)')} AS p75, max({x}) AS max FROM {view}")
        return out
    q["profile_numeric_summary"] = with_fixtures(select=_union(
        num("sales", "sales_raw", _cols_role("sales", "numeric", "amount", "duration"))
        + num("events", "events_raw", _cols_role("events", "numeric", "amount", "duration"))))
    q["profile_once_per_order"] = with_fixtures(ORDER_FIRST, select=_union(num("orders", "order_first",
                                                                               ["ship_cost"])))
    parts = []
    for tbl, view in RAW_VIEW.items():
        for c in _cols_role(tbl, "categorical", "ordinal"):
            f = f"(SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {view} WHERE {c} IS NOT NULL GROUP BY 1)"
            parts.append(f"SELECT '{tbl}' AS tbl, '{c}' AS column, count(*) AS distinct, "
                         f"arg_min(v, {{'a': -n, 'b': v}}) AS top_value, max(n) AS top_freq, "
                         f"{r2('max(n) * 100.0 / sum(n)')} AS top_pct FROM {f} x")
    q["profile_categorical_summary"] = with_fixtures(select=_union(parts))
    q["profile_categorical_values"] = with_fixtures(select=_union([
        f"SELECT '{tbl}' AS tbl, '{c}' AS column, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {view} "
        f"WHERE {c} IS NOT NULL GROUP BY {c}"
        for tbl, view in RAW_VIEW.items() for c in _cols_role(tbl, "categorical", "ordinal")]))
    for name, col, view in (("freq_channel", "channel", "sales_raw"), ("freq_state", "state", "events_raw"),
                            ("freq_quantity", "quantity", "sales_raw"), ("freq_rating", "rating", "sales_raw")):
        q[name] = with_fixtures(select=f"""
SELECT {col} AS value, count(*) AS count, {r2(f'count(*) * 100.0 / (SELECT count(*) FROM {view})')} AS share_pct
FROM {view} WHERE {col} IS NOT NULL GROUP BY {col}""")
    q["profile_conditional_nulls"] = with_fixtures(select=f"""
SELECT 'store_id null by physical channel' AS "check",
  count(*) FILTER (WHERE channel = 'BUILDING' AND store_id IS NULL) AS nulls_inside,
  count(*) FILTER (WHERE channel = 'BUILDING') AS rows_inside,
  count(*) FILTER (WHERE NOT coalesce(channel = 'BUILDING', false) AND store_id IS NULL) AS nulls_outside,
  count(*) FILTER (WHERE NOT coalesce(channel = 'BUILDING', false)) AS rows_outside,
  CASE WHEN count(*) FILTER (WHERE channel = 'BUILDING' AND store_id IS NULL) = 0 THEN 'normal' ELSE 'problem' END
    AS verdict
FROM sales_raw
UNION ALL
SELECT 'carrier null before dispatch / in transport',
  count(*) FILTER (WHERE NOT coalesce(state IN {TRANSPORT}, false) AND carrier IS NULL),
  count(*) FILTER (WHERE NOT coalesce(state IN {TRANSPORT}, false)),
  count(*) FILTER (WHERE coalesce(state IN {TRANSPORT}, false) AND carrier IS NULL),
  count(*) FILTER (WHERE coalesce(state IN {TRANSPORT}, false)),
  CASE WHEN count(*) FILTER (WHERE coalesce(state IN {TRANSPORT}, false) AND carrier IS NULL) = 0
       THEN 'normal' ELSE 'problem' END
FROM events_raw
UNION ALL
SELECT 'tracking_no null before dispatch / in transport',
  count(*) FILTER (WHERE NOT coalesce(state IN {TRANSPORT}, false) AND tracking_no IS NULL),
  count(*) FILTER (WHERE NOT coalesce(state IN {TRANSPORT}, false)),
  count(*) FILTER (WHERE coalesce(state IN {TRANSPORT}, false) AND tracking_no IS NULL),
  count(*) FILTER (WHERE coalesce(state IN {TRANSPORT}, false)),
  CASE WHEN count(*) FILTER (WHERE coalesce(state IN {TRANSPORT}, false) AND tracking_no IS NULL) = 0
       THEN 'normal' ELSE 'problem' END
FROM events_raw
UNION ALL
SELECT 'note present without incident', count(*) FILTER (WHERE note IS NOT NULL AND incident IS NULL),
  count(note), 0, 0, 'normal'
FROM events_raw""")
    q["profile_nulls_by_state"] = with_fixtures(select="""
SELECT state, count(*) AS nulls FROM events_raw WHERE stage_hours IS NULL GROUP BY state""")
    q["check_amount_identities"] = with_fixtures(select=f"""
SELECT count(*) AS rows,
  count(*) FILTER (WHERE coalesce(abs(unit_price * quantity - gross) > 1, false)) AS gross_broken,
  count(*) FILTER (WHERE coalesce(abs(gross * discount_rate - discount) > 1, false)) AS discount_broken,
  count(*) FILTER (WHERE coalesce(abs(gross - discount - net) > 1, false)) AS net_broken,
  {r2('''avg(CASE WHEN coalesce(abs(unit_price * quantity - gross) > 1, false)
              OR coalesce(abs(gross * discount_rate - discount) > 1, false)
              OR coalesce(abs(gross - discount - net) > 1, false) THEN 0.0 ELSE 1.0 END) * 100''')} AS pct_all_hold
FROM sales_raw""")

    def negs(tbl, view):
        cols = [c for c, t in RAW_TYPES[tbl] if t.startswith("decimal") or t in ("bigint", "int", "double")]
        return "(SELECT " + " + ".join(f"count(*) FILTER (WHERE {c} < 0)" for c in cols) + f" FROM {view})"
    q["check_negatives"] = with_fixtures(select=f"""
SELECT {negs('sales', 'sales_raw')} AS sales_negative_cells, {negs('events', 'events_raw')} AS events_negative_cells,
       {negs('sales', 'sales_raw')} + {negs('events', 'events_raw')} AS negative_cells""")
    q["check_referential"] = with_fixtures(select="""
SELECT (SELECT count(*) FROM sales_raw s WHERE NOT EXISTS (SELECT 1 FROM events_raw e WHERE e.order_id = s.order_id))
         AS sales_without_events,
       (SELECT count(*) FROM (SELECT DISTINCT order_id FROM events_raw) e
        WHERE NOT EXISTS (SELECT 1 FROM sales_raw s WHERE s.order_id = e.order_id)) AS event_orders_without_sale""")
    q["check_city_mismatch"] = with_fixtures(ORDER_FIRST, select="""
SELECT count(*) FILTER (WHERE c.city IS DISTINCT FROM f.dest_city) AS orders_with_other_city
FROM order_first f LEFT JOIN (SELECT order_id, min(city) AS city FROM sales_raw GROUP BY order_id) c
  ON c.order_id = f.order_id
WHERE f.dest_city IS NOT NULL""")
    q["check_events_per_order"] = with_fixtures(
        "per AS (SELECT order_id, count(*) AS n FROM events_raw GROUP BY order_id)", select="""
SELECT min(n) AS min_events, max(n) AS max_events,
       (SELECT n FROM (SELECT n, count(*) AS k FROM per GROUP BY n) ORDER BY k DESC, n LIMIT 1) AS mode_events
FROM per""")
    q["check_incomplete_trace"] = with_fixtures("""per AS (
  SELECT order_id, count(DISTINCT state) AS n FROM events_raw GROUP BY order_id)""", select="""
SELECT count(*) FILTER (WHERE n < (SELECT count(DISTINCT state) FROM events_raw)) AS incomplete_orders,
       count(*) AS orders FROM per""")
    q["check_constant_in_group"] = with_fixtures("""per AS (
  SELECT order_id, min(ship_cost) AS lo, max(ship_cost) AS hi FROM events_raw GROUP BY order_id)""", select="""
SELECT count(*) FILTER (WHERE lo = hi) AS constant_orders, count(*) AS orders FROM per""")
    q["check_shared_tracking"] = with_fixtures(select="""
SELECT tracking_no, count(DISTINCT order_id) AS orders FROM events_raw WHERE tracking_no IS NOT NULL
GROUP BY tracking_no HAVING count(DISTINCT order_id) > 1""")
    q["check_unparseable_dates"] = with_fixtures(select="""
SELECT count(*) FILTER (WHERE event_ts_txt IS NOT NULL AND try_cast(event_ts_txt AS TIMESTAMP) IS NULL)
         AS event_ts_txt_unparseable,
       count(*) FILTER (WHERE promised_ts_txt IS NOT NULL AND try_cast(promised_ts_txt AS TIMESTAMP) IS NULL)
         AS promised_ts_txt_unparseable
FROM events_raw""")
    q["check_residual_columns"] = with_fixtures(select="""
SELECT 'unnamed_13' AS column, count(DISTINCT unnamed_13) AS distinct_values FROM events_raw""")
    q["check_residual_values"] = with_fixtures(select="""
SELECT 'unnamed_13' AS column, unnamed_13 AS value, count(*) AS n FROM events_raw
WHERE unnamed_13 IS NOT NULL GROUP BY unnamed_13""")
    timeline = """timeline AS (
  SELECT e.order_id, e.event_id, e.state, e.event_ts_txt, try_cast(e.event_ts_txt AS TIMESTAMP) AS event_ts,
         try_cast(e.promised_ts_txt AS TIMESTAMP) AS promised_ts, s.sale_ts
  FROM events_raw e LEFT JOIN sales_raw s ON s.order_id = e.order_id)"""
    q["check_event_before_sale"] = with_fixtures(timeline, select="""
SELECT count(*) FILTER (WHERE event_ts < sale_ts) AS events_before_sale FROM timeline""")
    q["check_promise_before_sale"] = with_fixtures(timeline, select="""
SELECT count(*) FILTER (WHERE promised_ts <= sale_ts) AS orders_promise_before_sale FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_id NULLS FIRST, state NULLS FIRST,
    event_ts_txt NULLS FIRST, promised_ts NULLS FIRST, sale_ts NULLS FIRST) AS rn FROM timeline) WHERE rn = 1""")
    q["check_out_of_order"] = with_fixtures(select="""
SELECT count(DISTINCT order_id) AS orders_out_of_order FROM (
  SELECT order_id, ts, lag(ts) OVER (PARTITION BY order_id ORDER BY event_id, ts) AS prev
  FROM (SELECT order_id, event_id, try_cast(event_ts_txt AS TIMESTAMP) AS ts FROM events_raw) x
  WHERE ts IS NOT NULL) y WHERE ts < prev""")
    q["first_state_distribution"] = with_fixtures("""fs AS (
  SELECT order_id, arg_min(state, {'e': event_id, 'v': state}) FILTER (WHERE state IS NOT NULL) AS first_state
  FROM events_raw GROUP BY order_id)""", select="""
SELECT first_state, count(*) AS orders FROM fs WHERE first_state IS NOT NULL GROUP BY first_state""")
    parts = []
    for tbl, view, cols in (("sales", "sales_raw", ("city", "channel", "category", "product", "pay_method")),
                            ("events", "events_raw", ("state", "center", "dest_city", "carrier", "incident", "note"))):
        for c in cols:
            parts.append(f"SELECT '{tbl}' AS tbl, '{c}' AS column, "
                         f"count(*) FILTER (WHERE {_clean(c)} <> {c}) AS changed_cells, "
                         f"count(DISTINCT {c}) AS distinct_raw, count(DISTINCT lower({_clean(c)})) AS distinct_clean_lower, "
                         f"count(DISTINCT lower({_clean(c)})) < count(DISTINCT {c}) AS has_variants "
                         f"FROM {view} WHERE {c} IS NOT NULL")
    q["standardize_impact"] = with_fixtures(select=_union(parts))
    accented = ("accented AS (SELECT CASE WHEN sale_id % 5 = 0 THEN translate(city, 'AEIOU', 'ÁÉÍÓÚ') WHEN sale_id % 7 = 0 THEN lower(city) "
                "ELSE city END AS city, channel FROM sales_raw)")
    q["standardize_impact_accents"] = with_fixtures(accented, select=_union([
        f"SELECT 'sales' AS tbl, '{c}' AS column, CAST(count(*) FILTER (WHERE {_clean(c)} <> {c}) AS BIGINT) AS changed_cells, count(DISTINCT {c}) AS distinct_raw, "
        f"count(DISTINCT strip_accents(lower({_clean(c)}))) AS distinct_clean_lower, "
        f"count(DISTINCT strip_accents(lower({_clean(c)}))) < count(DISTINCT {c}) AS has_variants FROM accented WHERE {c} IS NOT NULL" for c in ("city", "channel")]))
    diff_cols = [c for c, _ in RAW_TYPES["events"] if c != "event_id"]
    q["conflict_diff_columns"] = with_fixtures(
        "d AS (SELECT DISTINCT * FROM events_raw)",
        "c AS (SELECT * FROM d WHERE event_id IN (SELECT event_id FROM d GROUP BY event_id HAVING count(*) > 1))",
        "long AS (" + _union([f"SELECT event_id, '{c}' AS column, count(DISTINCT coalesce(CAST({c} AS VARCHAR), "
                              f"chr(0))) AS nd FROM c GROUP BY event_id" for c in diff_cols]) + ")",
        select="SELECT event_id, string_agg(\"column\", ', ' ORDER BY \"column\") AS columns FROM long WHERE nd > 1 "
               "GROUP BY event_id")
    for col in ("net", "unit_price"):
        place = f"least(floor((CAST({col} AS DOUBLE) - lo) / (hi - lo) * 20), 19)"
        q[f"histogram_{col}"] = with_fixtures(
            f"b AS (SELECT min(CAST({col} AS DOUBLE)) AS lo, max(CAST({col} AS DOUBLE)) AS hi FROM sales_raw)",
            select=f"""
SELECT CAST({place} AS INTEGER) AS bin, count(*) AS count, {r2(f'lo + {place} * (hi - lo) / 20')} AS lower,
  {r2(f'lo + ({place} + 1) * (hi - lo) / 20')} AS upper
FROM sales_raw, b WHERE {col} IS NOT NULL GROUP BY ALL""")
    q["boxplot_stage_hours"] = with_fixtures(
        "qq AS (SELECT quantile_cont(stage_hours, 0.25) AS q1, quantile_cont(stage_hours, 0.75) AS q3 FROM events_raw)",
        select=f"""
SELECT {r2('quantile_cont(stage_hours, 0.25)')} AS q1, {r2('quantile_cont(stage_hours, 0.5)')} AS median,
  {r2('quantile_cont(stage_hours, 0.75)')} AS q3, {r2('any_value(q1 - (q3 - q1) * 1.5)')} AS lower_fence,
  {r2('any_value(q3 + (q3 - q1) * 1.5)')} AS upper_fence,
  count(*) FILTER (WHERE stage_hours < q1 - (q3 - q1) * 1.5 OR stage_hours > q3 + (q3 - q1) * 1.5) AS outliers,
  count(stage_hours) AS count
FROM events_raw, qq""")
    bronze_nulls = _union([f"SELECT '{EV_COLS[EV_RAW_COLS.index(c)] if c in EV_RAW_COLS else c}' AS column, "
                           f"count(*) - count({c}) AS nulls_bronze FROM events_raw"
                           for c, _ in RAW_TYPES["events"]])
    silver_nulls = _union([f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls_silver FROM e_clean"
                           for c in EV_COLS])
    before_sales = _union([f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls_bronze FROM sales_raw" for c in SALES_COLS])
    after_sales = _union([f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls_silver FROM s_clean" for c in SALES_COLS])
    strategy = """CASE WHEN {n}.column IS NULL THEN 'column dropped'
  WHEN {b}.column IN ('incident', 'note') THEN 'explicit category'
  WHEN {b}.column IN ('carrier', 'tracking_no') THEN 'value of the order, in transport states only'
  WHEN {b}.column IN ('center', 'dest_city', 'promised_ts') THEN 'value of the order'
  WHEN {b}.column IN ('stage_hours', 'event_ts', 'store_id', 'rating') THEN 'kept null' END AS strategy"""
    q["null_before_after"] = silver(
        f"nb AS ({bronze_nulls})", f"ns AS ({silver_nulls})", f"sb AS ({before_sales})", f"ss AS ({after_sales})", select=f"""
SELECT 'events' AS tbl, coalesce(nb.column, ns.column) AS column, nb.nulls_bronze, ns.nulls_silver, {strategy.format(b='nb', n='ns')}
FROM nb FULL OUTER JOIN ns ON ns.column = nb.column
UNION ALL
SELECT 'sales', coalesce(sb.column, ss.column), sb.nulls_bronze, ss.nulls_silver, {strategy.format(b='sb', n='ss')}
FROM sb FULL OUTER JOIN ss ON ss.column = sb.column""")
    verdicts = {"store_id": "normal", "rating": "normal", "stage_hours": "normal", "incident": "normal", "note": "normal",
                "carrier": "normal before dispatch, a problem in transport",
                "tracking_no": "normal before dispatch, a problem in transport", "center": "problem", "dest_city": "problem",
                "promised_ts_txt": "problem", "event_ts_txt": "problem", "unnamed_13": "problem (residual column)"}
    q["profile_null_findings"] = with_fixtures(select=_union([
        f"SELECT '{tbl}' AS tbl, '{c}' AS column, count(*) AS rows, count(*) - count({c}) AS nulls, "
        f"'{verdicts.get(c, 'unexplained')}' AS verdict FROM {view}"
        + ("" if c == "unnamed_13" else f" HAVING count(*) > count({c})")
        for tbl, view in RAW_VIEW.items() for c, _ in RAW_TYPES[tbl]]))
    q["check_conditional_presence"] = with_fixtures(select="""
SELECT coalesce(bool_and(store_id IS NULL) FILTER (WHERE NOT coalesce(channel = 'BUILDING', false)), true)
         AS null_outside,
       coalesce(bool_and(store_id IS NOT NULL) FILTER (WHERE coalesce(channel = 'BUILDING', false)), true)
         AS present_inside,
       coalesce(bool_and(store_id IS NULL) FILTER (WHERE NOT coalesce(channel = 'BUILDING', false)), true)
       AND coalesce(bool_and(store_id IS NOT NULL) FILTER (WHERE coalesce(channel = 'BUILDING', false)), true)
         AS exact
FROM sales_raw""")
    return q


# ------------------------------------------------------------------ A, G (landing, pipeline, ledger)
LOAD_FIRST, LOAD_STRICT = "20240101_000000", "20240102_000000"

#: Published tables: layer, name, CTE here, columns.
TABLES = [("silver", "sales", "s_clean", 17), ("silver", "events", "e_clean", 13),
          ("silver", "sales_rejected", "s_rej", 18), ("silver", "events_rejected", "e_rej", 14),
          ("silver", "incidents", "incidents", 7), ("gold", "orders", "g_orders", 38),
          ("gold", "events", "g_events", 25), ("gold", "kpi_monthly", "m_month", 14),
          ("gold", "carrier_performance", "m_carrier", 9), ("gold", "city_channel_sales", "m_cc", 8)]
PUBLISHED = [(layer, name) for layer, name, _, _ in TABLES]
_SALE_KEY = ["sale_id", "order_id", "sale_ts", "customer_id", "city", "channel", "store_id", "category", "product",
             "pay_method", "quantity", "unit_price", "discount_rate", "gross", "discount", "net", "rating"]
_EVENT_KEY = ["event_id", "order_id", "event_ts", "state", "center", "dest_city", "carrier", "tracking_no",
              "promised_ts", "ship_cost", "incident", "note"]
#: Columns whose text is compared after an export: all but doubles, which engines print differently.
EXPORT_KEYS = {
    "silver.sales": _SALE_KEY, "silver.sales_rejected": [*_SALE_KEY, "reject_reason"],
    "silver.events": _EVENT_KEY, "silver.events_rejected": [*_EVENT_KEY, "reject_reason"],
    "silver.incidents": ["source", "level", "key", "order_id", "kind", "action", "detail"],
    "gold.orders": [*_SALE_KEY, "n_events", "n_states", "final_state", "center", "dest_city", "carrier",
                    "tracking_no", "ship_cost", "n_incidents", "delivered", "late", "trace_complete", "month"],
    "gold.events": ["order_id", "event_id"],
    "gold.kpi_monthly": ["month", "orders", "net"],
    "gold.carrier_performance": ["carrier", "orders"],
    "gold.city_channel_sales": ["city", "channel", "orders", "net"],
    "bronze.sales": _SALE_KEY,
    "bronze.events": ["event_id", "order_id", "event_ts_txt", "state", "center", "dest_city", "carrier", "tracking_no",
                      "promised_ts_txt", "ship_cost", "incident", "note", "unnamed_13"],
}


def whole(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([duckdb_ctes(), *SILVER_CTES, *INCIDENT_CTES, *GOLD_CTES, *MART_CTES, *ctes]) + "\n" + select


def _sha_row(cols) -> str:
    return "sha256(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in cols) + "))"


def ag_queries() -> dict[str, str]:
    q = {}
    gold_cols = "*"
    q["pipeline_run"] = whole(select=f"SELECT {gold_cols}, '{LOAD_FIRST}' AS load_id FROM g_orders")
    q["lineage_stamp"] = whole(select=f"SELECT event_id, order_id, '{LOAD_FIRST}' AS load_id FROM e_clean")
    q["run_ledger"] = whole(select=_union([
        f"SELECT '{layer}' AS layer, '{name}' AS table, count(*) AS rows, {ncols} AS columns FROM {cte}"
        for layer, name, cte, ncols in TABLES]))
    q["reprocess_load"] = whole(select=_union([
        f"SELECT '{layer}' AS layer, '{name}' AS table, count(*) AS rows, true AS same_content FROM {cte}"
        for layer, name, cte, _ in TABLES if layer == "gold" or name in ("sales", "events")]))
    rules = e_queries()
    silver_passed = "(SELECT count(*) FILTER (WHERE passed) FROM (" + rules["silver_rules"] + "))"
    n_silver = "(SELECT count(*) FROM (" + rules["silver_rules"] + "))"
    n_all = n_silver + " + (SELECT count(*) FROM (" + rules["gold_rules"] + "))"
    # a published run has passed every rule
    q["run_history"] = f"""
SELECT 1 AS seq, '{LOAD_FIRST}' AS load_id, 'etl' AS origin, 'PUBLISHED' AS status, {n_all} AS rules_passed,
       {n_all} AS rules_total, false AS on_newest_load
UNION ALL SELECT 2, '{LOAD_FIRST}', 'reprocess', 'PUBLISHED', {n_all}, {n_all}, false
UNION ALL SELECT 3, '{LOAD_STRICT}', 'etl', 'FAILED', {silver_passed}, {n_silver}, true"""
    q["bronze_land"] = with_fixtures(select=f"SELECT *, '{LOAD_STRICT}' AS load_id FROM sales_raw")
    q["bronze_read_load"] = with_fixtures(select="SELECT * FROM events_raw")
    per_load = _union([f"SELECT '{lid}' AS load_id, (SELECT count(*) FROM sales_raw) AS sales_rows, "
                       "(SELECT count(*) FROM events_raw) AS events_rows" for lid in (LOAD_FIRST, LOAD_STRICT)])
    q["bronze_list_loads"] = with_fixtures(select=per_load)
    q["bronze_retention"] = with_fixtures(f"loads AS ({per_load})", select="""
SELECT load_id, sales_rows, CAST(dense_rank() OVER (ORDER BY load_id DESC) AS INTEGER) AS rank,
       dense_rank() OVER (ORDER BY load_id DESC) > 1 AS drop FROM loads""")
    q["write_layer_counts"] = with_fixtures(select="""
SELECT 'sales' AS source, (SELECT count(*) FROM sales_raw) AS rows, 17 AS columns
UNION ALL SELECT 'events', (SELECT count(*) FROM events_raw), 14""")
    q["source_fingerprint"] = with_fixtures(select=f"SELECT *, {_sha_row(SALES_COLS)} AS row_sha256 FROM sales_raw")
    q["extraction_probe"] = with_fixtures(select="""
SELECT 'sales' AS source, count(*) AS rows, 17 AS columns FROM sales_raw
UNION ALL SELECT 'events', count(*), 14 FROM events_raw""")
    numbers = {"sales": ("sale_id", "order_id", "customer_id", "quantity", "unit_price", "discount_rate", "gross", "discount", "net", "rating"),
               "events": ("event_id", "order_id", "stage_hours", "ship_cost")}
    for t, cols in (("sales", SALES_COLS), ("events", [c for c, _ in RAW_TYPES["events"]])):  # two loads of the same rows, all errors held
        q[f"profile_loads_{t}"] = with_fixtures(select=_union([
            f"SELECT '{c}' AS column, 2 * count(*) AS rows, 2 * (count(*) - count({c})) AS nulls, true AS distinct_ok, "
            f"{'true' if c in numbers[t] else 'CAST(NULL AS BOOLEAN)'} AS quantiles_ok FROM {t}_raw" for c in cols]))
    q["extraction_columns"] = with_fixtures(select=_union([f"SELECT '{t}' AS source, {at} AS position, '{c}' AS column, count({c}) AS filled FROM {t}_raw" for t, cols in (
        ("sales", SALES_COLS), ("events", [c for c, _ in RAW_TYPES["events"]])) for at, c in enumerate(cols, 1)]))
    ev_cols = [c for c, _ in RAW_TYPES["events"]]
    q["extraction_head"] = with_fixtures(select=f"SELECT * FROM sales_raw ORDER BY sale_id NULLS FIRST, {_all_nulls_first(SALES_COLS)} LIMIT 5")
    for name, view, key, cols in (("extraction_sample", "sales_raw", "sale_id", SALES_COLS), ("extraction_sample_events", "events_raw", "event_id", ev_cols)):
        q[name] = with_fixtures(select=f"SELECT * FROM {view} ORDER BY md5(coalesce(CAST({key} AS VARCHAR), '\\N') || '|42'), {_all_nulls_first(cols)} LIMIT 5")
    q["land_events_text"] = with_fixtures(select="SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM events_raw")
    views = {f"{layer}.{name}": cte for layer, name, cte, _ in TABLES} | {"bronze.sales": "sales_raw", "bronze.events": "events_raw"}

    def chars(key):
        return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in key) + ")"
    q["export_tables"] = whole(select=_union([
        f"SELECT '{name}' AS table, count(*) AS rows, CAST(sum(length({chars(EXPORT_KEYS[name])})) AS BIGINT) AS chars FROM {cte}"
        for name, cte in views.items()]))
    return q


#: Which increment brings an event: most orders come whole, in the first or the second; the rest, and late events, come last.
INCREMENT = "CASE WHEN event_id % 70 = 2 OR event_id IS NULL THEN 3 WHEN order_id % 3 = 0 THEN 1 WHEN order_id % 3 = 1 THEN 2 ELSE 3 END"


def stream_queries() -> dict[str, str]:
    """What increments publish is what a batch over all events publishes, in which of equally complete versions of
    an event the one of the earliest increment stays."""
    first = f"ORDER BY {_NULLS}, {_all_nulls_first(EV_RAW_COLS)}"
    by_arrival = f"ORDER BY {_NULLS}, {INCREMENT}, {_all_nulls_first(EV_RAW_COLS)}"
    batch = {"stream_publish": whole(select="SELECT * FROM g_orders"), "stream_publish_events": whole(select="SELECT * FROM e_clean"),
             "stream_publish_incidents": c_queries()["incident_log"], "stream_publish_city_channel": d_queries()["city_channel_sales"]}
    return {"stream_landing": "SELECT * FROM events"} | {name: sql.replace(first, by_arrival) for name, sql in batch.items()}


def arrival_queries() -> dict[str, str]:
    def down(columns):
        return ", ".join(f"{c} DESC NULLS LAST" for c in columns)
    raw = [*EV_RAW_COLS, "unnamed_13"]
    early = ", ".join("'zz early' AS note" if c == "note" else c for c in raw)
    events = f"""
WITH {duckdb_ctes()},
came AS (
  SELECT DISTINCT 1 AS delivery, {early} FROM events_raw WHERE event_id % 3 = 0
  UNION ALL SELECT 2, {', '.join(raw)} FROM events_raw),
versions AS (SELECT min(delivery) AS delivery, count(*) AS copies, {', '.join(raw)} FROM came GROUP BY {', '.join(raw)})
SELECT event_id, order_id, note, copies,
  row_number() OVER (PARTITION BY event_id ORDER BY {_NULLS}, delivery, {down(raw)}) = 1 AS kept
FROM versions"""
    first = f"CASE WHEN pay_method = 'ZZ-DUP' THEN 1 ELSE 2 END, {down(SALES_COLS)}"
    ctes = [cte.replace(_all_nulls_first(SALES_COLS), first) for cte in SILVER_SALES_CTES]
    return {"arrival_events": events, "arrival_sales": with_fixtures(*ctes, select="SELECT sale_id, pay_method, net, reject_reason FROM s_flag")}


def b_extra_queries() -> dict[str, str]:
    q = {}
    ev_all = ", ".join(c for c, _ in RAW_TYPES["events"])
    sa_all = ", ".join(SALES_COLS)

    def extra(view, cols):
        return f"(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {view} GROUP BY {cols}) x)"
    q["profile_duplicates"] = with_fixtures(
        f"full_ev AS (SELECT event_id, count(*) AS n FROM events_raw GROUP BY {ev_all})",
        "per_id AS (SELECT event_id, sum(n) AS r, max(n) AS mx FROM full_ev GROUP BY event_id HAVING sum(n) > 1)",
        select=f"""
SELECT {extra('sales_raw', sa_all)} AS sales_duplicate_rows,
       {extra('sales_raw', 'sale_id')} AS sales_sale_id_repeated,
       {extra('sales_raw', 'order_id')} AS sales_order_id_repeated,
       {extra('events_raw', ev_all)} AS events_duplicate_rows,
       {extra('events_raw', 'event_id')} AS events_event_id_repeated,
       (SELECT count(*) FILTER (WHERE mx > 1) FROM per_id) AS events_event_id_repeated_identical,
       (SELECT count(*) FILTER (WHERE mx = 1) FROM per_id) AS events_event_id_repeated_different,
       {extra('events_raw', 'order_id')} AS events_order_id_repeated,
       (SELECT count(*) FROM (SELECT tracking_no FROM events_raw WHERE tracking_no IS NOT NULL
        GROUP BY tracking_no HAVING count(DISTINCT order_id) > 1) t) AS shared_tracking_numbers""")
    parts = []
    for tbl, view in RAW_VIEW.items():
        for c, t in RAW_TYPES[tbl]:
            role = ROLES[tbl][c]
            pct = (r2(f"count(try_cast({c} AS TIMESTAMP)) * 100.0 / nullif(count({c}), 0)")
                   if role == "date" and t == "string" else "CAST(NULL AS DOUBLE)")
            verdict = TYPE_VERDICTS.get(c, "OK (text)")
            src = view if pct != "CAST(NULL AS DOUBLE)" else f"(SELECT count(*) AS n FROM {view}) x"
            parts.append(f"SELECT '{tbl}' AS tbl, '{c}' AS column, '{t}' AS type, '{role}' AS role, "
                         f"'{verdict}' AS verdict, {pct} AS parseable_pct FROM {src}")
    q["profile_type_check"] = with_fixtures(select=_union(parts))
    return q
