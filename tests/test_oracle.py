"""Every named query gives the rows of its SQL."""

import os

import pytest

import __spark_entry__
from logweir.queries import ORACLES, QUERIES
from logweir.session import materialise, release, scratch_path, scratch_table
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0
    release(spark)


def test_release_leaves_nothing(spark):
    table = scratch_table("left")
    spark.range(3).write.option("path", scratch_path(spark, "left")).saveAsTable(table)
    out = materialise(spark.range(3), "left")
    assert out.count() == 3 and spark.catalog.tableExists(table)
    folder = out.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    release(spark)
    assert not spark.catalog.tableExists(table) and not os.path.exists(folder)
    release(spark)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
