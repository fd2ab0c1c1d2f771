"""Every registered query against its SQL twin; the others must give rows."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SLOW = {"grid_search_classifier", "learning_curve", "recommender_search", "recommender_regressors", "recommend_with_model"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, sf, name):
    status, _, _, note = compare(spark, con, sf, name, queries()[name], oracle_sql()[name])
    assert status == "ok", note


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_gives_rows(spark, sf, name):
    assert queries()[name](spark, sf).limit(1).count() == 1


def test_entry(spark):
    assert entry(spark).count() > 0
