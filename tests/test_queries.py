import pytest
from helpers import same_as_duckdb

from genpulse.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_its_sql(spark, name):
    same_as_duckdb(spark, SF, catalog.QUERIES[name], catalog.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
