import pytest

from tests.oracle import same_rows
from tideglass.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, duck, name):
    same_rows(QUERIES[name](spark, sf_dir), duck, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert all(callable(f) for f in e.queries().values())
