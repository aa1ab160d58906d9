"""Hash-seeded numbers that Spark SQL and other SQL engines compute alike, from md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hex digits taken from an md5: 52 bits, which a double holds exactly.
DIGITS = 13
RANGE = float(1 << 52)


def hash_number(key: Column) -> Column:
    """A long in [0, 2**52)."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, DIGITS), 16, 10).cast("long")


def hash_fraction(key: Column) -> Column:
    """A double in [0, 1)."""
    return hash_number(key) / F.lit(RANGE)


def row_key(row_id: str = "doc_id", text: str = "text") -> Column:
    """A row's key: its id, or for a null id its text's md5."""
    return F.coalesce(F.col(row_id).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))
