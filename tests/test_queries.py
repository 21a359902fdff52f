"""Every query against its closed-form check on the smallest city."""

import pytest
from compare import checking_engine, differences

import __spark_entry__ as entry
from testbed.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def engine():
    return checking_engine("sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_check(spark, engine, name):
    assert differences(spark, engine, QUERIES[name], ORACLES[name], "sf0.001") == ""


def test_unchecked_queries_give_rows(spark):
    assert set(QUERIES) - set(ORACLES) == {"classify_buildings"}
    assert QUERIES["classify_buildings"](spark, "/root/testdata/sf0.001").count() == 200


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 10 and "compac_mean_w" in df.columns
