"""Column helpers that carry the pandas-compatible semantics.

Every helper returns a built-in Spark ``Column`` so it stays inside
whole-stage codegen; nothing here is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def false_if_null(pred: Column) -> Column:
    """Two-valued mask: a comparison with NULL is False."""
    return F.coalesce(pred, F.lit(False))


def in_list(c, values: Iterable) -> Column:
    """``isin`` where NULL is simply not a member."""
    return false_if_null(col_(c).isin(list(values)))


def not_in_list(c, values: Iterable) -> Column:
    """pandas ``~isin``: NULL counts as *outside* the list."""
    return ~in_list(c, values)


def round_half_even(c, digits: int = 2) -> Column:
    """numpy ``round`` on a double: half-even on the scaled binary value."""
    scale = float(10 ** digits)
    return F.rint(col_(c).cast("double") * F.lit(scale)) / F.lit(scale)


def days_between(start, end) -> Column:
    """(end - start) in fractional days; NULL if either side is NULL."""
    return F.timestamp_diff("MICROSECOND", col_(start), col_(end)) / F.lit(MICROS_PER_DAY)


def clean_text(c) -> Column:
    """Collapse every run of (Unicode) whitespace to one blank and trim.

    The regular expression is kept for texts that it can change: those with two blanks in a row, another white space
    of ASCII or a character beyond ASCII."""
    col = col_(c)
    odd = F.octet_length(col) != F.length(col)
    for white in ("  ", "\t", "\n", "\v", "\f", "\r"):
        odd = odd | F.contains(col, F.lit(white))
    return F.trim(F.when(odd, F.regexp_replace(col, r"(?U)\s+", " ")).otherwise(col))


def parse_ts(c, formats: Sequence[str | None] = (None,)) -> Column:
    """Text -> TIMESTAMP_NTZ, NULL when no format matches (S18, never throws)."""
    tries = []
    for fmt in formats:
        if fmt is None:
            tries.append(F.expr(f"try_cast(`{c}` AS TIMESTAMP_NTZ)") if isinstance(c, str)
                         else col_(c).try_cast("timestamp_ntz"))
        else:
            tries.append(F.try_to_timestamp(col_(c), F.lit(fmt)).cast("timestamp_ntz"))
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


def safe_pct(num, den) -> Column:
    """num / den * 100 as double; NULL (not an error) when den is 0."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double")) * F.lit(100.0)


def mean_pct(flag) -> Column:
    """pandas ``mean()*100`` of a (nullable) boolean: nulls skipped."""
    return F.avg(col_(flag).cast("double")) * F.lit(100.0)


def first_by(value, *order) -> Column:
    """First non-null ``value`` in ``order`` (pandas group ``first``, S1).

    ``min_by`` skips rows whose ordering is NULL, so the ordering is nulled
    where the value is NULL.
    """
    key = order[0] if len(order) == 1 else F.struct(*order)
    return F.min_by(col_(value), F.when(col_(value).isNotNull(), col_(key)))


def last_by(value, *order) -> Column:
    key = order[0] if len(order) == 1 else F.struct(*order)
    return F.max_by(col_(value), F.when(col_(value).isNotNull(), col_(key)))


def sum_or_zero(c) -> Column:
    """pandas ``sum`` of an all-null group is 0."""
    return F.coalesce(F.sum(col_(c)), F.lit(0))


def null_count(cols: Iterable[str]) -> Column:
    """Number of NULL cells in a row."""
    parts = [F.col(c).isNull().cast("int") for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def money(c) -> Column:
    return col_(c).cast("decimal(38,2)")


def money_sum(c) -> Column:
    """Exact decimal sum, widened to decimal(38,2) in both engines."""
    return F.sum(col_(c)).cast("decimal(38,2)")
