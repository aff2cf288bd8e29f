"""Every named query with SQL, next to DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from clickloom.plans import queries as named
from clickloom.sources.training_view import training_view
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, duck, name):
    assert compare(queries()[name](spark, SF_DIR), duck, SQL[name]) == ""


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["report_runs", "model_comparison"])
def test_reports_join_the_view_once(spark, monkeypatch, name):
    made = []

    def view(*args):
        made.append(training_view(*args))
        return made[-1]

    monkeypatch.setattr(named, "training_view", view)
    found = queries()[name](spark, SF_DIR)
    assert len(made) == 1
    assert "lineitem" not in found._jdf.queryExecution().toString()
