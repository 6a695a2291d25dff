"""Each registered query of the library itself against its oracle, on the smallest tables."""

import pytest

from gristmill.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_oracle(name, spark, sf, duck, canon):
    got, want = catalog.QUERIES[name](spark, sf).toPandas(), duck(sf, catalog.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_runs(name, spark, sf):
    assert catalog.QUERIES[name](spark, sf).columns


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
