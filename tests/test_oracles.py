"""Every registered query against its SQL oracle, all values compared."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from tabfold.catalogue import ORACLES, QUERIES

# Fitted models without a closed form; their invariants are tested elsewhere.
NO_ORACLE = {"sentiment_scores", "tree_scores"}


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, folder, name):
    problem, n_rows = compare(spark, connection, folder, name)
    assert problem is None
    assert n_rows > 0


def test_every_other_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == NO_ORACLE
    assert set(ORACLES) <= set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["rmse"]
