import pytest
from compare import duck, rows

from audiweave.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert rows(registry.QUERIES[name](spark, sf_dir).toPandas()) == rows(duck(sf_dir, registry.ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
