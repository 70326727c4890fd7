"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

import pytest
from compare import differences, sql_engine

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Fitted models are covered by test_models on small frames.
SLOW = {"grid_search", "refitted_settings", "naive_bayes_stack", "top_coefficients", "logistic_variants"}


@pytest.fixture(scope="module")
def engine():
    return sql_engine(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, engine, name):
    assert differences(QUERIES[name](spark, FOLDER), engine, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_gives_rows(spark):
    result = entry.entry(spark)
    assert result.columns == ["day", "n", "n_gone", "gone_rate"]
    assert result.count() == 29


def test_names_match():
    assert set(SQL) <= set(QUERIES)
