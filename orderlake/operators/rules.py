"""Quality gate: 21 Silver rules and 12 Gold rules.

The ``count_if``-style violation counters of a Silver table are observed while a
run writes it, else it is scanned by ONE aggregate holding all of them; counters that need another table (coverage, orphans,
reconciliation totals) are scalar subqueries, never cross joins. The one-row
result is unpivoted to ``(layer, rule_id, rule, violations, passed)``. Only
that 33-row table ever reaches the driver (the gate, E3).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.contract import Contract
from orderlake.functions.semantics import false_if_null, in_list
from orderlake.operators.silver import repeated_keys, rows_of_repeated

RULE_COLS = ("layer", "rule_id", "rule", "violations", "passed")


class GateError(Exception):
    """At least one quality rule failed; nothing is published."""

    def __init__(self, failed: list[tuple]):
        self.failed = failed
        super().__init__(f"{len(failed)} quality rule(s) failed: "
                         + "; ".join(f"{r[0]}: {r[1]} {r[2]}" + (f" ({r[3]})" if len(r) > 3 else "") for r in failed))


def _repeats(df: DataFrame, *keys: str) -> Column:
    """pandas ``duplicated().sum()``: rows beyond the first of each key (NULL is one value),
    as one partially aggregated count by the key."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))).scalar())


def _out_of_coverage(df: DataFrame, col: str, contract: Contract, coverage: DataFrame | None) -> Column:
    vals = df.where(F.col(col).isNotNull()).select(F.col(col).alias("city")).distinct()
    if coverage is None:
        return vals.where(~in_list("city", contract.coverage or ())).agg(F.count(F.lit(1))).scalar()
    return vals.join(coverage.select("city").distinct(), "city", "left_anti").agg(F.count(F.lit(1))).scalar()


def _rows(one_row: DataFrame, layer: str, specs: list[tuple[str, str, str, Column]]) -> DataFrame:
    """specs: (rule_id, rule, counter column name, pass condition) -> long rule rows."""
    stacked = one_row.select(F.explode(F.array(*[
        F.struct(F.lit(layer).alias("layer"), F.lit(rid).alias("rule_id"), F.lit(text).alias("rule"),
                 F.col(c).cast("bigint").alias("violations"), ok.alias("passed"))
        for rid, text, c, ok in specs])).alias("r"))
    return stacked.select("r.*")


def _within(counter: str, rule_id: str, rows: Column, contract: Contract | None) -> Column:
    """The rule holds if no more rows break it than the contract tolerates (by default none)."""
    pct = (contract.tolerated_pct if contract else {}).get(rule_id, 0.0)
    return F.col(counter) * F.lit(100.0) <= F.lit(pct) * F.coalesce(rows, F.lit(0))


def _is_ts(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes).get(col, "").startswith("timestamp")


def row_counters(table: str, contract: Contract, rows: Column | None = None) -> list[Column]:
    """The counters of the rules that a Silver row breaks by itself (R3-R5, R11-R17) and ``_rows``.

    Over the rows for which ``rows`` holds, all by default. They are plain partial aggregates, so they can be observed
    while the table is written; ``silver_rules`` then need not scan it for them.
    """
    which = F.lit(True) if rows is None else rows

    def count(*broken: Column) -> Column:
        return functools.reduce(Column.__add__, [F.count_if(which & false_if_null(b)) for b in broken])
    if table == "sales":
        counted = {"r3": [F.col("sale_ts").isNull()],
                   "r4": [F.col("rating").isNotNull() & ~false_if_null(F.col("rating").between(contract.rating_min, contract.rating_max))],
                   "r5": [F.col(a) < 0 for a in ("unit_price", "gross", "discount", "net")]}
    else:
        transport = in_list("state", contract.transport_states)
        counted = {"r11": [F.col("center").isNull()], "r12": [F.col("dest_city").isNull()], "r13": [F.col("promised_ts").isNull()],
                   "r14": [transport & F.col("carrier").isNull()], "r15": [~transport & F.col("carrier").isNotNull()],
                   "r16": [transport & F.col("tracking_no").isNull()], "r17": [~transport & F.col("tracking_no").isNotNull()]}
    return [F.count_if(which).alias("_rows"), *[count(*broken).alias(rule) for rule, broken in counted.items()]]


def silver_rules(sales: DataFrame, events: DataFrame, contract: Contract, raw_sales_rows: Column,
                 rejected_sales_rows: Column, raw_event_rows: Column, rejected_event_rows: Column,
                 coverage: DataFrame | None = None, seen: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """E1 + E4 (R1-R21) on the Silver tables.

    ``seen`` has by table the values of ``row_counters`` that were observed while it was written; a table that
    it lacks is scanned for them.
    """
    def counters(df: DataFrame, table: str) -> DataFrame:
        if seen and table in seen:
            return df.sparkSession.range(1).select(*[F.lit(n).cast("bigint").alias(c) for c, n in seen[table].items()])
        return df.agg(*row_counters(table, contract))
    s = counters(sales, "sales").withColumns({"r1": _repeats(sales, "sale_id"), "r2": _repeats(sales, "order_id"),
                       "r6": _out_of_coverage(sales, "city", contract, coverage)})
    ts_ok = _is_ts(sales, "sale_ts")
    sales_specs = [
        ("R1", "sale_id unique", "r1", _within("r1", "R1", F.col("_rows"), contract)),
        ("R2", "order_id unique", "r2", _within("r2", "R2", F.col("_rows"), contract)),
        ("R3", "sale_ts is a timestamp without nulls", "r3", F.lit(ts_ok) & _within("r3", "R3", F.col("_rows"), contract)),
        ("R4", "rating between 1 and 5 (or null)", "r4", _within("r4", "R4", F.col("_rows"), contract)),
        ("R5", "amounts not negative", "r5", _within("r5", "R5", F.col("_rows"), contract)),
        ("R6", "cities inside coverage", "r6", _within("r6", "R6", F.col("_rows"), contract)),
    ]
    cols = events.columns
    # identical rows have the same event_id, so only rows of repeated ids are compared as a whole
    ident = _repeats(rows_of_repeated(events, "event_id"), *cols)
    orphans = (events.join(sales.select("order_id").distinct(), "order_id", "left_anti")
               .agg(F.count(F.lit(1))).scalar())
    residual = sum(1 for c in cols if c.lower().startswith("unnamed"))
    dates_ok = _is_ts(events, "event_ts") and _is_ts(events, "promised_ts")
    e = counters(events, "events").withColumns({"r7": _repeats(events, "event_id"), "r8": ident, "r9": F.lit(residual), "r10": F.lit(0 if dates_ok else 1),
                       "r18": _out_of_coverage(events, "dest_city", contract, coverage), "r19": orphans,
                       "r20": rejected_sales_rows, "r20_den": raw_sales_rows,
                       "r21": rejected_event_rows, "r21_den": raw_event_rows})
    lim = F.lit(contract.max_reject_pct)

    def share_ok(n, den):
        return F.coalesce(F.try_divide(F.col(n).cast("double") * 100.0, F.col(den).cast("double")),
                          F.lit(0.0)) <= lim
    event_specs = [
        ("R7", "event_id unique", "r7", _within("r7", "R7", F.col("_rows"), contract)),
        ("R8", "no identical rows", "r8", _within("r8", "R8", F.col("_rows"), contract)),
        ("R9", "no residual columns", "r9", _within("r9", "R9", F.col("_rows"), contract)),
        ("R10", "date columns are timestamps", "r10", _within("r10", "R10", F.col("_rows"), contract)),
        ("R11", "center without nulls", "r11", _within("r11", "R11", F.col("_rows"), contract)),
        ("R12", "dest_city without nulls", "r12", _within("r12", "R12", F.col("_rows"), contract)),
        ("R13", "promised_ts without nulls", "r13", _within("r13", "R13", F.col("_rows"), contract)),
        ("R14", "carrier present in transport states", "r14", _within("r14", "R14", F.col("_rows"), contract)),
        ("R15", "carrier absent before dispatch", "r15", _within("r15", "R15", F.col("_rows"), contract)),
        ("R16", "tracking_no present in transport states", "r16", _within("r16", "R16", F.col("_rows"), contract)),
        ("R17", "tracking_no absent before dispatch", "r17", _within("r17", "R17", F.col("_rows"), contract)),
        ("R18", "destination cities inside coverage", "r18", _within("r18", "R18", F.col("_rows"), contract)),
        ("R19", "every event order exists in sales", "r19", _within("r19", "R19", F.col("_rows"), contract)),
        ("R20", "sales quarantine share within limit", "r20", share_ok("r20", "r20_den")),
        ("R21", "events quarantine share within limit", "r21", share_ok("r21", "r21_den")),
    ]
    return _rows(s, "silver_sales", sales_specs).unionByName(_rows(e, "silver_events", event_specs))


#: Gaps that a contract may expect, and the rule whose comparison allows for them.
GAPS = {"sales_without_events": "R27", "orders_without_carrier": "R31"}


def gap_sizes(silver_sales: DataFrame, silver_events: DataFrame, contract: Contract | None) -> dict[str, Column]:
    """Rows that each expected gap accounts for, by rule, counted from Silver (never from the table that is checked)."""
    there = {"sales_without_events": F.lit(True), "orders_without_carrier": F.col("carrier").isNotNull()}
    sizes = {}
    for gap in sorted(contract.expected_gaps if contract else ()):
        orders = silver_events.where(there[gap]).select("order_id").distinct()
        sizes[GAPS[gap]] = silver_sales.join(orders, "order_id", "left_anti").agg(F.count(F.lit(1))).scalar()
    return sizes


def gold_rules(silver_sales: DataFrame, silver_events: DataFrame, gold_events: DataFrame,
               gold_orders: DataFrame, marts: dict[str, DataFrame], contract: Contract | None = None) -> DataFrame:
    """E2 (R22-R33): one row per sale, net reconciles, marts reconcile."""
    n_sales = silver_sales.agg(F.count(F.lit(1))).scalar()
    net_silver = silver_sales.agg(F.sum("net")).scalar()
    n_events = silver_events.agg(F.count(F.lit(1))).scalar()
    gaps = gap_sizes(silver_sales, silver_events, contract)
    n_gold_events = gold_events.agg(F.count(F.lit(1))).scalar()
    amounts_in_events = sum(1 for c in ("unit_price", "gross", "discount", "net") if c in gold_events.columns)
    g = gold_orders.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("net").alias("_net"),
        F.count_if(F.col("n_events").isNull()).alias("r25"),
        F.count_if(F.col("ship_cost").isNull()).alias("r26"))
    g = g.withColumns({
        "r22": F.abs(F.col("_rows") - n_sales),
        "r23": _repeats(gold_orders, "order_id"),
        "r24": F.when(F.abs(F.coalesce(F.col("_net"), F.lit(0)) - F.coalesce(net_silver, F.lit(0))) >= 1, 1)
                .otherwise(0),
        "r27": F.abs(n_gold_events - n_events - gaps.get("R27", F.lit(0))),
        "r28": F.lit(amounts_in_events)})
    specs = [
        ("R22", "one row per Silver sale", "r22", _within("r22", "R22", F.col("_rows"), contract)),
        ("R23", "order_id unique", "r23", _within("r23", "R23", F.col("_rows"), contract)),
        ("R24", "net equals Silver net", "r24", _within("r24", "R24", F.col("_rows"), contract)),
        ("R25", "every order has an event summary", "r25", _within("r25", "R25", F.col("_rows"), contract)),
        ("R26", "ship_cost without nulls", "r26", _within("r26", "R26", F.col("_rows"), contract)),
        ("R27", "one row per Silver event", "r27", _within("r27", "R27", F.col("_rows"), contract)),
        ("R28", "no sale amounts in the event table", "r28", _within("r28", "R28", F.col("_rows"), contract)),
    ]
    ids = iter(["R29", "R30", "R31", "R32", "R33"])
    extra = {}
    for name, mart in marts.items():
        rid = next(ids)
        extra[rid] = F.abs(mart.agg(F.coalesce(F.sum("orders"), F.lit(0))).scalar() - F.col("_rows") + gaps.get(rid, F.lit(0)))
        specs.append((rid, f"{name}: orders reconcile", rid.lower(), _within(rid.lower(), rid, F.col("_rows"), contract)))
        if "net" in mart.columns:
            rid = next(ids)
            extra[rid] = F.when(F.abs(F.coalesce(mart.agg(F.sum("net")).scalar(), F.lit(0))
                                      - F.coalesce(F.col("_net"), F.lit(0))) >= 1, 1).otherwise(0)
            specs.append((rid, f"{name}: net reconciles", rid.lower(), _within(rid.lower(), rid, F.col("_rows"), contract)))
    g = g.withColumns({k.lower(): v for k, v in extra.items()})
    return _rows(g, "gold", specs)


#: How many of the values that break a rule its detail names, and what the count of violations counts.
EXAMPLES = 5
WHAT = {
    "R1": "repeated", "R2": "repeated", "R3": "null", "R4": "out of range", "R5": "negative", "R6": "outside coverage",
    "R7": "repeated", "R8": "repeated", "R9": "residual", "R10": "not a timestamp", "R11": "null", "R12": "null", "R13": "null",
    "R14": "null", "R15": "filled", "R16": "null", "R17": "filled", "R18": "outside coverage", "R19": "orphan events",
    "R20": "rejected", "R21": "rejected", "R22": "difference", "R23": "repeated", "R24": "difference", "R25": "without events",
    "R26": "null", "R27": "difference", "R28": "amounts", "R29": "difference", "R30": "difference", "R31": "difference",
    "R32": "difference", "R33": "difference"}


def k_smallest_distinct(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """(group, smallest: the k smallest distinct values in order, n_distinct), with memory independent of the rows.

    Equal values collapse by a partial aggregate; a window limit then keeps k rows of a group in each task
    before the shuffle and merges these, so no list holds more than k values.
    """
    distinct = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    counted = distinct.groupBy(group).agg(F.count(F.lit(1)).alias("n_distinct"))
    place = F.row_number().over(Window.partitionBy(group).orderBy(value))
    few = distinct.select(group, value, place.alias("_at")).where(F.col("_at") <= k)
    lists = few.groupBy(group).agg(F.array_sort(F.collect_list(value)).alias("smallest"))
    return lists.join(counted, group)


def _offending(df: DataFrame, key: str, broken: dict[str, Column]) -> DataFrame:
    """(rule_id, value): the key of each row that breaks a rule, from one pass."""
    hits = F.array_compact(F.array(*[F.when(false_if_null(cond), F.lit(rule)) for rule, cond in broken.items()]))
    return df.select(F.explode(hits).alias("rule_id"), F.col(key).cast("string").alias("value"))


def _of_rule(df: DataFrame, rule: str, column: str) -> DataFrame:
    return df.select(F.lit(rule).alias("rule_id"), F.col(column).cast("string").alias("value"))


def _uncovered(df: DataFrame, rule: str, col: str, contract: Contract, coverage: DataFrame | None) -> DataFrame:
    if coverage is None:
        out = df.where(F.col(col).isNotNull() & ~in_list(col, contract.coverage or ()))
    else:
        out = df.join(coverage.select(F.col("city").alias(col)).distinct(), col, "left_anti").where(F.col(col).isNotNull())
    return _of_rule(out, rule, col)


def silver_offenders(sales: DataFrame, events: DataFrame, contract: Contract, coverage: DataFrame | None = None) -> DataFrame:
    """(rule_id, value): what breaks R1-R19: keys, cities outside coverage, names of columns."""
    negative = [false_if_null(F.col(a) < 0) for a in ("unit_price", "gross", "discount", "net")]
    transport = in_list("state", contract.transport_states)
    of_sales = {"R3": F.col("sale_ts").isNull(), "R5": negative[0] | negative[1] | negative[2] | negative[3],
                "R4": F.col("rating").isNotNull() & ~false_if_null(F.col("rating").between(contract.rating_min, contract.rating_max))}
    of_events = {"R11": F.col("center").isNull(), "R12": F.col("dest_city").isNull(), "R13": F.col("promised_ts").isNull(),
                 "R14": transport & F.col("carrier").isNull(), "R15": ~transport & F.col("carrier").isNotNull(),
                 "R16": transport & F.col("tracking_no").isNull(), "R17": ~transport & F.col("tracking_no").isNotNull()}
    same = rows_of_repeated(events, "event_id").groupBy(*events.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts = [_offending(sales, "sale_id", of_sales), _offending(events, "event_id", of_events),
             _of_rule(repeated_keys(sales, "sale_id"), "R1", "_k"), _of_rule(repeated_keys(sales, "order_id"), "R2", "_k"),
             _of_rule(repeated_keys(events, "event_id"), "R7", "_k"), _of_rule(same, "R8", "event_id"),
             _uncovered(sales, "R6", "city", contract, coverage), _uncovered(events, "R18", "dest_city", contract, coverage),
             _of_rule(events.join(sales.select("order_id").distinct(), "order_id", "left_anti"), "R19", "order_id")]
    columns = [("R9", c) for c in events.columns if c.lower().startswith("unnamed")]
    columns += [("R10", c) for c in ("event_ts", "promised_ts") if not _is_ts(events, c)]
    if columns:
        parts.append(sales.sparkSession.createDataFrame(columns, "rule_id string, value string"))
    return functools.reduce(DataFrame.unionByName, parts)


def gold_offenders(gold_events: DataFrame, gold_orders: DataFrame) -> DataFrame:
    """(rule_id, value): what breaks R23, R25, R26 and R28."""
    broken = {"R25": F.col("n_events").isNull(), "R26": F.col("ship_cost").isNull()}
    out = _offending(gold_orders, "order_id", broken).unionByName(_of_rule(repeated_keys(gold_orders, "order_id"), "R23", "_k"))
    columns = [("R28", c) for c in ("unit_price", "gross", "discount", "net") if c in gold_events.columns]
    return out.unionByName(gold_orders.sparkSession.createDataFrame(columns, "rule_id string, value string")) if columns else out


def rule_details(rules: DataFrame, offenders: DataFrame) -> DataFrame:
    """The rules with ``detail``: how many of what broke each, the first EXAMPLES values in text order, and how many more."""
    what = F.create_map(*[F.lit(x) for pair in WHAT.items() for x in pair])
    found = k_smallest_distinct(offenders, "rule_id", "value", EXAMPLES)  # a row per rule
    named = F.concat(F.lit(": "), F.array_join("smallest", ", "),
                     F.when(F.col("n_distinct") > EXAMPLES, F.concat(F.lit(" and "), (F.col("n_distinct") - EXAMPLES).cast("string"), F.lit(" more"))).otherwise(""))
    text = F.concat(F.col("violations").cast("string"), F.lit(" "), F.element_at(what, F.col("rule_id")),
                    F.when(F.col("n_distinct") > 0, named).otherwise(""))
    return rules.join(F.broadcast(found), "rule_id", "left").select(*RULE_COLS, text.alias("detail"))


def plain_detail(rule: tuple) -> str:
    """The detail of a rule that nothing broke, or of which no value is to be named."""
    return f"{rule[3]} {WHAT[rule[1]]}"


def quarantine_share(raw_sales_rows, rejected_sales_rows, raw_event_rows, rejected_event_rows,
                     one_row: DataFrame, contract: Contract) -> DataFrame:
    """Rejected / raw rows (raw = before any dedup, S28) against the limit."""
    def row(src, rej, raw):
        pct = F.coalesce(F.try_divide(rej.cast("double") * 100.0, raw.cast("double")), F.lit(0.0))
        return F.struct(F.lit(src).alias("source"), rej.cast("bigint").alias("rejected"),
                        raw.cast("bigint").alias("raw_rows"),
                        (F.rint(pct * 100.0) / 100.0).alias("pct"),
                        (pct <= F.lit(contract.max_reject_pct)).alias("passed"))
    return one_row.select(F.explode(F.array(row("ventas", rejected_sales_rows, raw_sales_rows),
                                            row("logistica", rejected_event_rows, raw_event_rows))).alias("r")
                          ).select("r.*")


def gate_rows(rows: list[tuple]) -> list[tuple]:
    """E3 on already collected rule rows (layer, rule_id, rule, violations, passed[, detail])."""
    failed = [(r[0], r[1], r[2], *r[5:6]) for r in rows if not r[4]]
    if failed:
        raise GateError(failed)
    return rows


def gate(rules: DataFrame) -> list[tuple]:
    """Collect the (small, bounded) rule table; raise listing failures."""
    return gate_rows([tuple(r) for r in rules.select(*RULE_COLS).collect()])
