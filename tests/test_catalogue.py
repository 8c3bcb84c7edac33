"""Every registered query against its SQL form on the smallest tables."""

import harness
import pytest

from conduit.plans import catalogue


@pytest.fixture(scope="module")
def duck(folder):
    return harness.connect(folder)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, folder, name):
    df = catalogue.QUERIES[name](spark, folder)
    assert harness.differences(df, duck, catalogue.ORACLES[name]) is None


ROWS_ONLY = sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_returns_rows(spark, folder, name):
    df = catalogue.QUERIES[name](spark, folder)
    rows = df.collect()
    assert rows
    if "same" in df.columns:
        assert all(row["same"] for row in rows)


def test_oracles_have_queries():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["row_json"]
    # optional parts may add queries of their own
    assert set(contract.queries()) >= set(catalogue.QUERIES)
    assert set(contract.oracle_sql()) >= set(catalogue.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
