"""Every query against its SQL twin, order-free, on the supplied tables."""

import os

import pytest

from compare import database, differences
from pulsegrain.registry import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, db, key):
    result = QUERIES[key](spark, FOLDER).toArrow()
    if key in SQL:
        assert differences(result, db.sql(SQL[key]).to_arrow_table()) is None
    else:
        assert result.num_rows > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_numbered_rows_uses_every_core(spark):
    """A small table of products is one split, so one task worked on all of it."""
    assert QUERIES["numbered_rows"](spark, FOLDER).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
