import pytest

from millrace.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, sf_dir, oracle, rows_of, name):
    assert rows_of(catalogue.QUERIES[name](spark, sf_dir)) == oracle(catalogue.ORACLES[name])


def test_entry_registers_every_query():
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
