"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from snapmart.catalog import oracles, queries as catalog
from tests.compare import check, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.registered(), oracles.oracle_sql()


def test_names():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(SQL) == {"logreg_train_predict", "logreg_coefficients", "gbt_train_predict", "feature_importance",
                                       "batch_score", "monitor_models"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    problem = check(spark, duck(SF_DIR), SF_DIR, name, QUERIES[name], SQL.get(name))
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0
