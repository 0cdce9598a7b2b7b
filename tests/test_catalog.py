"""Every registered query against its SQL."""

import pytest
from comparison import connect, difference

import __spark_entry__ as entry_points
from flowspark.catalog.oracle import oracle_sql
from flowspark.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
ORACLE = oracle_sql()
# Results that SQL cannot repeat: MLlib's fits and Spark's own random draws.
ROWS_ONLY = {
    "bernoulli_sample",
    "random_split",
    "train_forest",
    "train_forest_wide",
    "score_batch",
    "train_and_evaluate",
    "stream_detect",
    "stream_detect_wide",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql_or_a_reason():
    assert set(ORACLE) == set(QUERIES) - ROWS_ONLY


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert difference(df, duck, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_catalog_is_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
