"""Every registered query against its reference SQL, on the smallest data set."""

import warnings

import pytest

import __spark_entry__ as entry_module
import compare

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry_module.registry.QUERIES, entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert compare.differences(spark, duck, QUERIES[name], SQL[name], SF) == []


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert {"fraud_flag", "insurance_risk_score", "premium_adjustment"} <= set(df.columns)
