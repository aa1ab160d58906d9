"""Declared columns of the two sources: what each column is, stated once.

Profiles take the declaration; nothing is guessed from a column's name or from
its values. A column that is not declared is residual: the source added it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

IDENTIFIER, DATE, AMOUNT, MEASURE, DURATION, SCALE, CATEGORY, RESIDUAL = (
    "identifier", "date", "amount", "numeric", "duration", "ordinal", "categorical", "residual")


@dataclass(frozen=True)
class TableSchema:
    """Roles by column of one source table."""

    roles: Mapping[str, str]

    def role(self, column: str) -> str:
        return self.roles.get(column, RESIDUAL)

    def having(self, columns: list[str], *roles: str) -> list[str]:
        """Those of ``columns`` that have one of the roles, in their order."""
        return [c for c in columns if self.role(c) in roles]


def _declare(**columns: str) -> TableSchema:
    return TableSchema({c: role for role, names in columns.items() for c in names.split()})


SALES = _declare(
    identifier="sale_id order_id customer_id store_id",
    date="sale_ts",
    categorical="city channel category product pay_method",
    amount="unit_price gross discount net",
    numeric="quantity discount_rate",
    ordinal="rating",
)
EVENTS = _declare(
    identifier="event_id order_id tracking_no",
    date="event_ts event_ts_txt promised_ts promised_ts_txt",
    categorical="state center dest_city carrier incident note",
    duration="stage_hours",
    amount="ship_cost",
)
TABLES = {"sales": SALES, "events": EVENTS}

#: Roles that are counted like categories, and those that are summarised like numbers.
CATEGORICAL = (CATEGORY, SCALE)
NUMERIC = (AMOUNT, MEASURE, DURATION)
