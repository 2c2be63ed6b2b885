"""Every registered query of the warehouse against its SQL counterpart on the smallest data set."""

import compare
import pytest

import __spark_entry__ as entry
from starmill.plans.catalogue import QUERIES
from starmill.plans.oracle import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare.differences(spark, con, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "season_label" and df.count() == 7
