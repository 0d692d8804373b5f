"""Every registered query against its DuckDB oracle (sf0.001), plus the entry smoke."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
_SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    a = df.toPandas()
    if name not in _SQL:
        assert len(a) > 0
        return
    b = con.execute(_SQL[name]).df()
    r = compare(a, b)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.schema == entry.entry(spark).schema


def test_percentiles_equal_brute_force_on_small_fixture(spark):
    """percentile_approx keeps every value below its compression threshold."""
    from railyard.plans.oracle import PERCENTILE_BRUTE_FORCE
    sf = "/root/testdata/sf0.01"
    a = entry.queries()["delay_percentiles"](spark, sf).toPandas()
    b = duck(sf).execute(PERCENTILE_BRUTE_FORCE).df()
    r = compare(a, b)
    assert r["ok"], r
