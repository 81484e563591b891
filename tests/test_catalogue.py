"""Every registered query that has SQL, against DuckDB on the smallest data set."""

from __future__ import annotations

import check
import pytest
from conftest import TINY

import __spark_entry__ as entry

WITH_SQL = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def db():
    return check.duck(TINY)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_its_sql(spark, db, name):
    rows, problem = check.compare(spark, db, TINY, name)
    assert problem is None
    assert rows > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["date_occ", "n", "ma"] and df.count() > 0
