"""Silver: cleaning, recovery, quarantine and the incident log.

Design for scale:

* "first in arrival order per key" is a ``groupBy(key).agg(min(struct(order,
  row)))``: partial aggregation collapses a hot key on the map side, so one
  key holding a third of the rows never lands whole in one task. Flagging
  the non-first rows joins that one-row-per-key result back, a join AQE can
  split when a key is skewed.
* every per-order value (recovery, fills, order summary) comes from one
  ``groupBy(order_id)`` aggregate joined back once, not from windows over an
  order partition (a window keeps a whole hot order in one task).
* incidents of all event-level kinds are produced in one pass as an array of
  structs that is exploded, not one scan per kind.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake import contract as K
from orderlake.contract import Contract
from orderlake.functions.semantics import (clean_text, false_if_null, first_by,
                                           in_list, null_count, parse_ts)
from orderlake.sources.landing import scratch

SALES_TEXT_COLS = ("city", "channel", "category", "product", "pay_method", "customer_id", "store_id")
SALES_AMOUNTS = ("unit_price", "gross", "discount", "net")
EVENT_TEXT_COLS = ("state", "center", "dest_city", "carrier", "tracking_no", "incident", "note")
EVENT_TS_TEXT = {"event_ts_txt": "event_ts", "promised_ts_txt": "promised_ts"}
ORDER_CONSTANT_COLS = ("center", "dest_city", "promised_ts")
TRANSPORT_COLS = ("carrier", "tracking_no")

# Source and level labels of the incident log.
SRC_SALES, SRC_EVENTS = "ventas", "logistica"
LVL_SALE, LVL_EVENT, LVL_COLUMN, LVL_ORDER = "venta", "evento", "columna", "pedido"

#: Column that holds a row's place of arrival, where a landing has recorded it.
ARRIVAL = "_arrival"
#: Copies of one row that a task lists at once.
COPIES_AT_ONCE = 10_000
#: Repeated keys that are sent to every task; of more the rows are not set apart.
KEYS_AT_ONCE = 1_000_000
#: Rows of one event id that may meet in one task, and events of one order that are sorted together.
HOT_ROWS = 100_000
HOT_ORDER = 10_000
#: Parts into which the keys fall before the keys of large parts are counted one by one.
KEY_PARTS = 1 << 16

INCIDENT_COLS = ("source", "level", "key", "order_id", "kind", "action", "detail")


# ------------------------------------------------------------------ helpers
def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def incident(source: str, level: str, key, order, kind, action, detail="") -> Column:
    """One incident as a struct of 7 strings (literals or columns)."""
    def lit_or(x):
        return x if isinstance(x, Column) else F.lit(x)
    return F.struct(F.lit(source).alias("source"), F.lit(level).alias("level"),
                    lit_or(key).cast("string").alias("key"), lit_or(order).cast("string").alias("order_id"),
                    lit_or(kind).alias("kind"), lit_or(action).alias("action"),
                    lit_or(detail).cast("string").alias("detail"))


def empty_incidents(spark) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in INCIDENT_COLS)
    return spark.createDataFrame([], schema)


def explode_incidents(df: DataFrame, items: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Turn (condition, incident struct) pairs into incident rows in one pass; rows without any are dropped before."""
    some = functools.reduce(Column.__or__, [false_if_null(cond) for cond, _ in items])
    arr = F.array(*[F.when(cond, inc) for cond, inc in items])
    return df.where(some).select(F.explode(arr).alias("i")).where(F.col("i").isNotNull()).select("i.*")


def coverage_flag(df: DataFrame, city_col: str, flag: str, contract: Contract,
                  coverage: DataFrame | None) -> DataFrame:
    """Add ``flag`` = city is inside the coverage list (NULL city -> False, S5).

    A literal list becomes ``isin``; a coverage DataFrame is joined (its size
    is what the planner checks before broadcasting).
    """
    if coverage is None:
        return df.withColumn(flag, in_list(city_col, contract.coverage or ()))
    cov = coverage.select(F.col("city").alias("_cov_city")).distinct().withColumn("_cov_hit", F.lit(True))
    return (df.join(cov, df[city_col] == cov["_cov_city"], "left")
            .withColumn(flag, F.coalesce(F.col("_cov_hit"), F.lit(False)))
            .drop("_cov_city", "_cov_hit"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (NULL is one key). A partially aggregated
    count: a hot key is reduced map-side to one row per partition."""
    return (df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
            .where(F.col("_c") > 1).select("_k"))


def first_rows(df: DataFrame, key: str, order_cols: Sequence[str] | None = None) -> DataFrame:
    """``(_k, _first)`` for the keys that occur more than once: the key's first
    row in arrival order as a struct.

    The count that finds the repeated keys shuffles the key alone; only rows of
    repeated keys are ranked, by a ``min(struct)`` that collapses a hot key
    map-side to one row per task."""
    few = rows_of_repeated(df, key)
    return few.groupBy(F.col(key).alias("_k")).agg(F.min(_arrival_struct(df, order_cols)).alias("_first"))


def rows_of_repeated(df: DataFrame, key: str) -> DataFrame:
    """The rows whose key occurs more than once (NULL is one key)."""
    return df.join(repeated_keys(df, key), F.col(key).eqNullSafe(F.col("_k")), "left_semi")


def few_repeated_keys(df: DataFrame, key: str) -> DataFrame | None:
    """``repeated_keys`` as a written table, or None if there are more than ``KEYS_AT_ONCE``.

    Their number is known before a join with them is planned, so they are broadcast and the rows that
    are looked up are not shuffled (beside the join a measured size comes too late for that)."""
    keys = scratch(repeated_keys(df, key))
    return keys if keys.count() <= KEYS_AT_ONCE else None


def hot_keys(df: DataFrame, key: str, most: int) -> DataFrame:
    """``(_k)``: the keys that more than ``most`` rows have, as a written table.

    Rows are counted by part of the keys first, which shuffles a few numbers; a key can only be hot in a part that has
    more than ``most`` rows, so keys are counted one by one in such parts alone."""
    known = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.pmod(F.xxhash64(key), F.lit(KEY_PARTS)).cast("int").alias("_part"))
    large = known.groupBy("_part").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > most).select("_part")
    counts = known.join(F.broadcast(large), "_part", "left_semi").groupBy("_k").agg(F.count(F.lit(1)).alias("_c"))
    return scratch(counts.where(F.col("_c") > most).select("_k"))


def marked(df: DataFrame, key: str, keys: DataFrame, flag: str) -> DataFrame:
    """``flag`` = the row's key is among ``keys`` (each once, NULL is a key), which are broadcast."""
    there = F.broadcast(keys.select(F.col("_k"), F.lit(True).alias("_there")))
    return (df.join(there, F.col(key).eqNullSafe(F.col("_k")), "left")
            .withColumn(flag, F.coalesce(F.col("_there"), F.lit(False))).drop("_k", "_there"))


def content_columns(df: DataFrame) -> list[str]:
    """The columns that make up a row's content: all but its place of arrival."""
    return [c for c in df.columns if c != ARRIVAL]


def _arrival_cols(df: DataFrame, order_cols: Sequence[str] | None) -> list[str]:
    """What orders rows by arrival: the landed place, or all columns where none was landed."""
    return list(order_cols) if order_cols else ([ARRIVAL] if ARRIVAL in df.columns else df.columns)


def _arrival_struct(df: DataFrame, order_cols: Sequence[str] | None) -> Column:
    return F.struct(*[F.col(c) for c in _arrival_cols(df, order_cols)])


def first_arrival_flags(df: DataFrame, key: str, flag: str, order_cols: Sequence[str] | None = None) -> DataFrame:
    """``flag`` = this row is NOT the first of its key in arrival order (pandas
    ``duplicated()``; null keys are one group).

    Only keys that repeat are joined back (AQE broadcasts them by measured
    size, or splits a skewed partition); rows of unique keys compare nothing."""
    return flag_non_first(df, [(key, flag, first_rows(df, key, order_cols))], order_cols)


def flag_non_first(df: DataFrame, specs: Sequence[tuple[str, str, DataFrame]],
                   order_cols: Sequence[str] | None = None) -> DataFrame:
    """Join several ``first_rows`` results (all computed from ``df`` itself, so
    the input is not re-derived once per key) and set one flag per key."""
    arrival = _arrival_struct(df, order_cols)
    out = df
    for i, (key, flag, firsts) in enumerate(specs):
        f = firsts.select(F.col("_k").alias(f"_k{i}"), F.col("_first").alias(f"_first{i}"))
        out = (out.join(f, out[key].eqNullSafe(f[f"_k{i}"]), "left")
               .withColumn(flag, F.when(F.col(f"_first{i}").isNull(), F.lit(False))
                           .otherwise(~arrival.eqNullSafe(F.col(f"_first{i}"))))
               .drop(f"_k{i}", f"_first{i}"))
    return out


# ------------------------------------------------------------------ C1
def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop identical rows; of each, the first to arrive stays."""
    if ARRIVAL not in df.columns:
        return df.dropDuplicates()
    return df.groupBy(*content_columns(df)).agg(F.min(ARRIVAL).alias(ARRIVAL)).select(*df.columns)


def copies(df: DataFrame, n: str) -> DataFrame:
    """Each row ``n`` - 1 times. A row with very many copies is expanded in pieces of
    ``COPIES_AT_ONCE`` that are dealt to all tasks."""
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(n) - 2) / COPIES_AT_ONCE))
    dealt = df.where(F.col(n) > 1).withColumn("_piece", F.explode(pieces))
    if_many = dealt.withColumn("_size", F.least(F.lit(COPIES_AT_ONCE), F.col(n) - 1 - F.col("_piece") * COPIES_AT_ONCE))
    spread = if_many.repartition("_piece", *[c for c in ("event_id",) if c in df.columns])
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size")))).drop("_piece", "_size", "_copy")


def duplicate_row_incidents(raw_events: DataFrame) -> DataFrame:
    """One incident per removed identical copy (count - 1 per distinct row)."""
    counted = raw_events.groupBy(*content_columns(raw_events)).agg(F.count(F.lit(1)).alias("_n"))
    return copies(counted.select("event_id", "order_id", "_n"), "_n").select(
        incident(SRC_EVENTS, LVL_EVENT, F.col("event_id"), F.col("order_id"),
                 K.KIND_DUPLICATE_ROW, K.ACTION_REMOVED).alias("i")).select("i.*")


# ------------------------------------------------------------------ C3
def residual_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.lower().startswith(K.RESIDUAL_PREFIX)]


def drop_residual(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop residual columns; one incident per column with its filled cells."""
    res = residual_columns(df)
    spark = df.sparkSession
    if not res:
        return df, empty_incidents(spark)
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in res])
    incs = None
    for c in res:
        one = counts.select(incident(SRC_EVENTS, LVL_COLUMN, F.lit(c), F.lit(""), K.KIND_RESIDUAL_COLUMN,
                                     K.ACTION_REMOVED,
                                     F.concat(F.col(f"`{c}`").cast("string"), F.lit(" celda(s) con datos")))
                            .alias("i")).select("i.*")
        incs = one if incs is None else incs.unionByName(one)
    return df.drop(*res), incs


# ------------------------------------------------------------------ C4
def resolve_key_conflicts(df: DataFrame, key: str = "event_id",
                          order_cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """C4: same key, different content -> keep the version with fewest NULLs,
    ties broken by arrival order; the others become incidents.

    The winner is the ``min(struct(n_nulls, arrival, row))`` per key: map-side
    partial aggregation keeps a hot key from gathering in one task.
    """
    cols = df.columns
    order = _arrival_cols(df, order_cols)
    ranked = df.withColumn("_nulls", null_count(content_columns(df)))
    if order == cols:  # the row itself is the tie-break: do not carry it twice
        rank_struct = F.struct(F.col("_nulls"), F.struct(*cols).alias("_row"))
    else:
        rank_struct = F.struct(F.col("_nulls"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                               F.struct(*cols).alias("_row"))
    winners = ranked.groupBy(key).agg(F.min(rank_struct).alias("_w"))
    kept = winners.select("_w._row.*")
    losers = (ranked.join(winners.select(F.col(key).alias("_k"), F.col("_w._row").alias("_wrow")),
                          F.col(key).eqNullSafe(F.col("_k")))
              .where(~F.struct(*cols).eqNullSafe(F.col("_wrow"))))
    incs = losers.select(incident(SRC_EVENTS, LVL_EVENT, F.col(key), F.col("order_id"), K.KIND_KEY_CONFLICT,
                                  K.ACTION_KEPT_MOST_COMPLETE).alias("i")).select("i.*")
    return kept, incs


# ------------------------------------------------------------------ C5-C7
def coerce_dates(df: DataFrame, mapping: dict[str, str], formats=(None,)) -> DataFrame:
    """Text -> timestamp with an explicit list of formats; bad text -> NULL."""
    out = df
    for src, dst in mapping.items():
        if src in out.columns:
            out = out.withColumn(dst, parse_ts(src, formats))
            if dst != src:
                out = out.drop(src)
    return out


def coerce_rating(df: DataFrame, col: str = "rating") -> DataFrame:
    """Ordinal -> nullable int; keeps ``_rating_fractional`` for the S20 rule."""
    number = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))  # NaN says no rating (S33)
    return (df.withColumn("_rating_fractional", false_if_null(number != F.floor(number)))
            .withColumn(col, number.cast("int")))


def normalize_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Trim + collapse whitespace on the string columns among ``cols``."""
    types = dict(df.dtypes)
    return df.withColumns({c: clean_text(c) for c in cols if types.get(c) == "string"})


# ------------------------------------------------------------------ C11-C12 sales
def _reasons(rules: Sequence[tuple[str, Column]]) -> Column:
    """Reasons joined with '; ' in rule order; '' = valid row."""
    return F.concat_ws("; ", *[F.when(false_if_null(cond), F.lit(name)) for name, cond in rules])


def _typed_sales(df: DataFrame, contract: Contract) -> DataFrame:
    """C5-C7 on sales."""
    if dict(df.dtypes).get("sale_ts") == "string":
        df = df.withColumn("sale_ts", parse_ts("sale_ts", contract.ts_formats))
    return normalize_text(coerce_rating(df), SALES_TEXT_COLS)


def _flag_repeats(sales_raw: DataFrame, contract: Contract, order_cols: Sequence[str] | None) -> DataFrame:
    """The distinct sales, typed, with ``_dup_sale`` and ``_dup_order``: not the first of its sale or order."""
    df = dedup_exact(sales_raw)
    order_cols = order_cols or ([ARRIVAL] if ARRIVAL in df.columns else None)
    df = _typed_sales(df, contract)
    order = order_cols or [c for c in content_columns(df) if c != "_rating_fractional"]
    return flag_non_first(df, [("sale_id", "_dup_sale", first_rows(df, "sale_id", order)),
                               ("order_id", "_dup_order", first_rows(df, "order_id", order))], order)


def flag_sales(sales_raw: DataFrame, contract: Contract, coverage: DataFrame | None = None,
               order_cols: Sequence[str] | None = None) -> DataFrame:
    """Deduplicate, type, clean, evaluate every row rule on the
    frame *before* any removal (S8). Adds ``reject_reason`` ('' = valid).

    A sale whose two keys occur once is no copy and the first of both: only the other sales are
    deduplicated and ranked, as long as few keys repeat."""
    again = {key: few_repeated_keys(sales_raw, key) for key in ("sale_id", "order_id")}
    if None in again.values():
        df = _flag_repeats(sales_raw, contract, order_cols)
    else:
        both = marked(marked(sales_raw, "sale_id", again["sale_id"], "_again_sale"), "order_id", again["order_id"], "_again_order")
        several, once = (both.where(cond).drop("_again_sale", "_again_order") for cond in (
            F.col("_again_sale") | F.col("_again_order"), ~F.col("_again_sale") & ~F.col("_again_order")))
        df = _flag_repeats(several, contract, order_cols).unionByName(
            _typed_sales(once, contract).withColumns({"_dup_sale": F.lit(False), "_dup_order": F.lit(False)}))
    base_cols = [c for c in content_columns(df) if c not in ("_rating_fractional", "_dup_sale", "_dup_order")]
    df = coverage_flag(df, "city", "_city_ok", contract, coverage)
    tol = F.lit(contract.amount_tolerance)
    neg = None
    for a in SALES_AMOUNTS:
        p = false_if_null(F.col(a) < 0)
        neg = p if neg is None else (neg | p)
    gross_bad = false_if_null(F.abs(F.col("unit_price") * F.col("quantity") - F.col("gross")) > tol)
    net_bad = false_if_null(F.abs(F.col("gross") - F.col("discount") - F.col("net")) > tol)
    rating_bad = F.col("rating").isNotNull() & ~false_if_null(
        F.col("rating").between(contract.rating_min, contract.rating_max))
    rules = [
        (K.SALES_REASONS[0], F.col("sale_ts").isNull()),
        (K.SALES_REASONS[1], ~F.col("_city_ok")),
        (K.SALES_REASONS[2], neg),
        (K.SALES_REASONS[3], gross_bad | net_bad),
        (K.SALES_REASONS[4], rating_bad),
        ("calificacion no entera", F.col("_rating_fractional")),
        (K.SALES_REASONS[5], F.col("_dup_sale")),
        (K.SALES_REASONS[6], F.col("_dup_order")),
    ]
    return df.withColumn("reject_reason", _reasons(rules)).select(*base_cols, "reject_reason")


def split_quarantine(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C11: (valid rows, rejected rows with ``reject_reason``)."""
    clean = flagged.where(F.col("reject_reason") == "").drop("reject_reason")
    rejected = flagged.where(F.col("reject_reason") != "")
    return clean, rejected


def rejected_incidents(rejected: DataFrame, source: str, level: str, key: str) -> DataFrame:
    return rejected.select(incident(source, level, F.col(key), F.col("order_id"), K.KIND_REJECTED,
                                    K.ACTION_QUARANTINED, F.col("reject_reason")).alias("i")).select("i.*")


def silver_sales(sales_raw: DataFrame, contract: Contract, coverage: DataFrame | None = None,
                 order_cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean sales, rejected sales, incidents)."""
    flagged = flag_sales(sales_raw, contract, coverage, order_cols)
    clean, rejected = split_quarantine(flagged)
    return clean, rejected, rejected_incidents(rejected, SRC_SALES, LVL_SALE, "sale_id")


# ------------------------------------------------------------------ events
def prepared_events(events_raw: DataFrame, order_cols: Sequence[str] | None = None) -> DataFrame:
    """C1-C4 as ONE table: every distinct raw row with its multiplicity ``_n``
    (C1, C2) and ``_win`` = the version kept for its ``event_id`` (C4: fewest
    NULLs outside residual columns, ties by arrival). Residual columns are kept
    here (C3 counts their cells and they break ties) and dropped downstream.

    Copies and versions share their ``event_id``, so the rows are shuffled once, by that id, and counted and ranked
    where they are. Ids with more than ``HOT_ROWS`` rows (``hot_keys``) and rows without id
    would meet in one task: their distinct rows are combined map-side before they are shuffled.
    Written once, it feeds the typed events and the duplicate / conflict
    incidents without recomputing the raw input.
    """
    hot = hot_keys(events_raw, "event_id", HOT_ROWS)
    split = marked(events_raw, "event_id", hot, "_hot").withColumn("_hot", F.col("_hot") | F.col("event_id").isNull())
    gathered = split.where(~F.col("_hot")).drop("_hot").repartition("event_id")
    return _versions(gathered, order_cols).unionByName(_versions(split.where("_hot").drop("_hot"), order_cols, null_key=True))


def _versions(events_raw: DataFrame, order_cols: Sequence[str] | None, null_key: bool = False) -> DataFrame:
    """Distinct rows with ``_n`` and ``_win``. Unless NULL is a key, a frame dealt by ``event_id`` is not shuffled again.

    Copies don't change which version is the first, so it is looked for among the rows as they are."""
    content = content_columns(events_raw)
    landed = ARRIVAL in events_raw.columns
    counted = events_raw.groupBy(*content).agg(F.count(F.lit(1)).alias("_n"), *([F.min(ARRIVAL).alias(ARRIVAL)] if landed else []))
    res = residual_columns(events_raw)
    keep = [c for c in content if c not in res]
    order = list(order_cols) if order_cols else ([ARRIVAL] if landed else keep)
    ranked = counted.withColumn("_nulls", null_count(keep))
    rank = F.struct(F.col("_nulls"), F.struct(*[F.col(c) for c in order + [c for c in res if c not in order]]))
    winners = events_raw.withColumn("_nulls", null_count(keep)).groupBy(F.col("event_id").alias("_k")).agg(F.min(rank).alias("_w"))
    same = ranked["event_id"].eqNullSafe(winners["_k"]) if null_key else ranked["event_id"] == winners["_k"]
    return (ranked.join(winners, same)
            .withColumn("_win", rank.eqNullSafe(F.col("_w")))
            .drop("_k", "_w", "_nulls", ARRIVAL))


def prepared_parts(prepared: DataFrame, contract: Contract) -> dict[str, DataFrame]:
    """Typed events and the C2/C3/C4 incidents, all read from the prepared table."""
    res = residual_columns(prepared)
    dup_inc = copies(prepared.select("event_id", "order_id", "_n"), "_n").select(incident(SRC_EVENTS, LVL_EVENT, F.col("event_id"), F.col("order_id"),
                                  K.KIND_DUPLICATE_ROW, K.ACTION_REMOVED).alias("i")).select("i.*")
    conf_inc = prepared.where(~F.col("_win")).select(
        incident(SRC_EVENTS, LVL_EVENT, F.col("event_id"), F.col("order_id"), K.KIND_KEY_CONFLICT,
                 K.ACTION_KEPT_MOST_COMPLETE).alias("i")).select("i.*")
    if res:
        res_inc = drop_residual(prepared.select(*res))[1]
    else:
        res_inc = empty_incidents(prepared.sparkSession)
    typed = prepared.where(F.col("_win")).drop(*res, "_n", "_win")
    typed = normalize_text(coerce_dates(typed, EVENT_TS_TEXT, contract.ts_formats), EVENT_TEXT_COLS)
    return {"typed": typed, "dup_inc": dup_inc, "res_inc": res_inc, "conf_inc": conf_inc}


def prepare_events(events_raw: DataFrame, contract: Contract,
                   order_cols: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """C1-C7 on events: dedup, residual drop, key conflicts, typing, text cleaning.

    Returns the typed frame and the incidents of those steps (lazily, from one
    prepared frame; pipelines write that frame once, see ``prepared_events``).
    """
    return prepared_parts(prepared_events(events_raw, order_cols), contract)


def order_firsts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """First non-null value per order in event order, one row per order."""
    return df.groupBy("order_id").agg(*[first_by(c, "event_id").alias(f"_first_{c}") for c in cols])


def recovery_values(typed: DataFrame) -> DataFrame:
    """What C8/C9 take from each order, one row per order."""
    return order_firsts(typed.where(F.col("order_id").isNotNull()), ORDER_CONSTANT_COLS + TRANSPORT_COLS)


def gathered_by_order(typed: DataFrame, valid_sales: DataFrame) -> DataFrame:
    """The typed events with what C8/C9 take from their order (``_first_*``) and ``_has_sale``, which C13 asks for.

    The events are shuffled once, by order, and sorted within the tasks: each order's values are taken and its sale is looked
    up where its events are. Orders with more than ``HOT_ORDER`` events (``hot_keys``) aren't
    gathered: their values are few and are broadcast. Events without order stay where they are.
    """
    of_order = F.col("order_id").isNotNull()
    hot = hot_keys(typed, "order_id", HOT_ORDER)
    split = marked(typed, "order_id", hot, "_hot")
    cols = ORDER_CONSTANT_COLS + TRANSPORT_COLS
    sales = _sale_keys(valid_sales)

    order = Window.partitionBy("order_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = {f"_first_{c}": F.first(F.when(F.col("event_id").isNotNull(), F.col(c)), ignorenulls=True).over(order) for c in cols}
    whole = split.where(of_order & ~F.col("_hot")).drop("_hot").repartition("order_id").withColumns(firsts)
    whole = whole.join(sales, whole["order_id"] == sales["_vk"], "left").drop("_vk")
    rest = [c for c in whole.columns if c not in typed.columns]
    out = whole.select(*typed.columns, *rest)
    large = split.where(of_order & F.col("_hot")).drop("_hot")
    values = recovery_values(large)
    values = values.join(sales, values["order_id"] == sales["_vk"], "left").drop("_vk")
    alone = typed.where(~of_order).select("*", *[F.lit(None).cast(t).alias(c) for c, t in whole.dtypes if c in rest])
    return out.unionByName(large.join(F.broadcast(values), "order_id").select(*out.columns)).unionByName(alone)


def _sale_keys(valid_sales: DataFrame) -> DataFrame:
    return valid_sales.select(F.col("order_id").alias("_vk")).where("_vk IS NOT NULL").withColumn("_has_sale", F.lit(True))


def recover_and_fill(typed: DataFrame, contract: Contract, firsts: DataFrame | None = None,
                     valid_sales: DataFrame | None = None) -> DataFrame:
    """Overwrite order-constant columns with the order's first value (S2),
    fill carrier/tracking only in transport states, explicit null categories.

    Keeps ``_was_null_*`` flags for the incident pass. Orders with a NULL key get
    no recovered value (S4).

    ``firsts`` is ``recovery_values`` read back from a written table: then both
    sides of the join are shuffled for it and AQE can split an order that holds
    very many events, which it can't while the aggregate feeds the join directly.
    Events without order are not joined, so they don't meet in one task. With ``valid_sales`` the events are shuffled
    once for the recovery and for ``flag_events`` (``gathered_by_order``).
    """
    if valid_sales is not None:
        df = gathered_by_order(typed, valid_sales)
    else:
        firsts = recovery_values(typed) if firsts is None else firsts
        added = [F.lit(None).cast(t).alias(c) for c, t in firsts.dtypes if c != "order_id"]
        df = typed.where(F.col("order_id").isNotNull()).join(firsts, "order_id", "left").unionByName(
            typed.where(F.col("order_id").isNull()).select("*", *added))
    transport = in_list("state", contract.transport_states)
    flags = {f"_was_null_{c}": F.col(c).isNull() for c in ORDER_CONSTANT_COLS}
    flags.update({f"_was_null_{c}": transport & F.col(c).isNull() for c in TRANSPORT_COLS})
    df = df.withColumns(flags)
    repl = {c: F.col(f"_first_{c}") for c in ORDER_CONSTANT_COLS}
    repl.update({c: F.when(transport & F.col(c).isNull(), F.col(f"_first_{c}")).otherwise(F.col(c))
                 for c in TRANSPORT_COLS})
    repl["incident"] = F.coalesce(F.col("incident"), F.lit(K.NO_INCIDENT))
    repl["note"] = F.coalesce(F.col("note"), F.lit(K.NO_NOTE))
    return df.withColumns(repl).drop(*[f"_first_{c}" for c in ORDER_CONSTANT_COLS + TRANSPORT_COLS])


def event_level_incidents(recovered: DataFrame) -> DataFrame:
    """C8, C9 and null event time incidents, one pass (array of structs + explode)."""
    items = []
    for c in ORDER_CONSTANT_COLS:
        items.append((F.col(f"_was_null_{c}"),
                      incident(SRC_EVENTS, LVL_EVENT, F.col("event_id"), F.col("order_id"),
                               c + K.KIND_NULL_SUFFIX, K.ACTION_RECOVERED)))
    for c in TRANSPORT_COLS:
        items.append((F.col(f"_was_null_{c}"),
                      incident(SRC_EVENTS, LVL_EVENT, F.col("event_id"), F.col("order_id"),
                               c + K.KIND_NULL_IN_TRANSPORT_SUFFIX, K.ACTION_COMPLETED)))
    items.append((F.col("event_ts").isNull(),
                  incident(SRC_EVENTS, LVL_EVENT, F.col("event_id"), F.col("order_id"),
                           K.KIND_EVENT_TS_NULL, K.ACTION_KEPT_NULL, F.col("state"))))
    return explode_incidents(recovered, items)


def recovery_outcomes(recovered: DataFrame) -> DataFrame:
    """C8, C9 by outcome (S3): how many incidents of each kind were resolved, and how many found no value
    in their order; the log itself names both alike."""
    kinds = ([(c, c + K.KIND_NULL_SUFFIX) for c in ORDER_CONSTANT_COLS] + [(c, c + K.KIND_NULL_IN_TRANSPORT_SUFFIX) for c in TRANSPORT_COLS])
    one = [F.when(F.col(f"_was_null_{c}"), F.struct(F.lit(kind).alias("kind"), F.col(c).isNotNull().alias("resolved"))) for c, kind in kinds]
    return (recovered.select(F.explode(F.array_compact(F.array(*one))).alias("i")).groupBy("i.kind", "i.resolved")
            .agg(F.count(F.lit(1)).alias("incidents")))


def flag_events(recovered: DataFrame, valid_sales: DataFrame, contract: Contract,
                coverage: DataFrame | None = None) -> DataFrame:
    """Row rules on events: the order has no valid sale; destination out of coverage.

    The valid order keys are joined as a flag (semi-join shape) — never
    collected to the driver. Valid sales hold an order once (C12 rejects the
    rest), so they need no ``distinct`` and AQE can split a skewed order. Events that
    know already whether they have a sale (``gathered_by_order``) are not joined.
    """
    keys = _sale_keys(valid_sales)
    df = recovered if "_has_sale" in recovered.columns else recovered.join(keys, recovered["order_id"] == keys["_vk"], "left").drop("_vk")
    df = coverage_flag(df, "dest_city", "_dest_ok", contract, coverage)
    rules = [(K.EVENT_REASONS[0], F.col("_has_sale").isNull()),
             (K.EVENT_REASONS[1], ~F.col("_dest_ok"))]
    return df.withColumn("reject_reason", _reasons(rules)).drop("_has_sale", "_dest_ok")


SILVER_EVENT_COLS = ("event_id", "order_id", "event_ts", "state", "center", "dest_city", "carrier",
                     "tracking_no", "promised_ts", "stage_hours", "ship_cost", "incident", "note")


def _event_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_") and c != "reject_reason"]


def shared_tracking_pairs(events: DataFrame) -> DataFrame:
    """Distinct (tracking_no, order_id) for tracking numbers used by
    more than one order. Pairs are deduplicated first (map-side), so a hot
    tracking number reduces to its distinct orders before the count."""
    pairs = events.where(F.col("tracking_no").isNotNull()).select("tracking_no", "order_id").distinct()
    shared = (pairs.groupBy("tracking_no").agg(F.count(F.lit(1)).alias("_orders"))
              .where("_orders > 1").select("tracking_no"))
    return pairs.join(shared, "tracking_no", "left_semi")


def shared_tracking_numbers(events: DataFrame) -> DataFrame:
    pairs = events.where(F.col("tracking_no").isNotNull()).select("tracking_no", "order_id").distinct()
    return (pairs.groupBy("tracking_no").agg(F.count(F.lit(1)).alias("orders"))
            .where("orders > 1"))


def order_level_incidents(silver_ev: DataFrame, contract: Contract) -> DataFrame:
    """C15-C17 on the post-quarantine events: missing states, delivered but
    undated, shared tracking numbers."""
    all_states = silver_ev.agg(F.sort_array(F.collect_set("state"))).scalar()
    delivered = F.col("state") == F.lit(contract.delivered_state)
    per = (silver_ev.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.collect_set("state").alias("_seen"),
        F.count_if(delivered).alias("_n_deliv"),
        F.count(F.when(delivered, F.col("event_ts"))).alias("_n_deliv_ts"))
        .withColumn("_missing", F.array_join(F.sort_array(F.array_except(all_states, F.col("_seen"))), ", ")))
    items = [
        (F.col("_missing") != "",
         incident(SRC_EVENTS, LVL_ORDER, F.col("order_id"), F.col("order_id"), K.KIND_INCOMPLETE_TRACE,
                  K.ACTION_MARKED_GOLD, F.concat(F.lit(K.MISSING_PREFIX), F.col("_missing")))),
        ((F.col("_n_deliv") > 0) & (F.col("_n_deliv_ts") == 0),
         incident(SRC_EVENTS, LVL_ORDER, F.col("order_id"), F.col("order_id"), K.KIND_DELIVERED_UNDATED,
                  K.ACTION_NO_DELIVERY_DATE)),
    ]
    per_order = explode_incidents(per, items)
    shared = shared_tracking_pairs(silver_ev).select(
        incident(SRC_EVENTS, LVL_ORDER, F.col("order_id"), F.col("order_id"), K.KIND_SHARED_TRACKING,
                 K.ACTION_MARKED_GOLD, F.col("tracking_no")).alias("i")).select("i.*")
    return per_order.unionByName(shared)


def silver_events(events_raw: DataFrame, valid_sales: DataFrame, contract: Contract,
                  coverage: DataFrame | None = None,
                  order_cols: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """C1-C17 for events: clean events, rejected events and incidents by step."""
    prep = prepare_events(events_raw, contract, order_cols)
    rec = recover_and_fill(prep["typed"], contract)
    ev_inc = event_level_incidents(rec)
    flagged = flag_events(rec, valid_sales, contract, coverage)
    cols = _event_cols(flagged)
    clean = flagged.where(F.col("reject_reason") == "").select(*cols)
    rejected = flagged.where(F.col("reject_reason") != "").select(*cols, "reject_reason")
    rej_inc = rejected_incidents(rejected, SRC_EVENTS, LVL_EVENT, "event_id")
    ord_inc = order_level_incidents(clean, contract)
    incidents = (prep["dup_inc"].unionByName(prep["res_inc"]).unionByName(prep["conf_inc"])
                 .unionByName(ev_inc).unionByName(rej_inc).unionByName(ord_inc))
    return {"clean": clean, "rejected": rejected, "incidents": incidents, "typed": prep["typed"],
            "recovered": rec}


def incident_summary(incidents: DataFrame) -> DataFrame:
    """Incidents by level, kind and action."""
    return incidents.groupBy("level", "kind", "action").agg(F.count(F.lit(1)).alias("incidents"))
