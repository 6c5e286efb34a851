import __spark_entry__ as contract
from oracle import ORACLE
from workload import QUERIES


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
