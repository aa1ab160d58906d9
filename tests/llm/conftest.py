from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def rows_of(spark):
    """Rows of a frame as dicts."""

    def rows(df):
        return [r.asDict() for r in df.collect()]

    return rows


@pytest.fixture(scope="session")
def table():
    """Rows of a table at sf0.01 as tuples of the named columns."""

    def read(name, *columns):
        return duckdb.sql(f"SELECT {', '.join(columns)} FROM '{SF}/{name}.parquet'").fetchall()

    return read


@pytest.fixture(scope="session")
def twin():
    """Rows of an oracle over Arrow tables, as sorted tuples, and its columns."""

    def run(sql, **tables):
        con = duckdb.connect()
        for name, arrow in tables.items():
            con.register(name, arrow)
        relation = con.sql(sql)
        return relation.columns, sorted(map(repr, relation.fetchall()))

    return run
