"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from compare import duck, difference
from dossier.queries.catalog import QUERIES
from dossier.queries.oracles import ORACLES

ROWS_ONLY = {"train_score_evaluate", "staged_metric", "gbt_importance"}


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


def test_all_queries_have_sql_but_the_models():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROWS_ONLY))
def test_query_agrees_with_sql(spark, sf, connection, name):
    assert difference(QUERIES[name](spark, sf), ORACLES[name], connection) is None


def test_entry_returns_rows(spark, sf):
    assert entry.entry(spark).count() > 0


def test_entry_holds_every_query(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
