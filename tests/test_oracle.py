"""Every registered query equals its SQL oracle (DuckDB) on sf0.001."""

import pytest

from conftest import SF_SMALL, canonical

from __spark_entry__ import oracle_sql, queries
from campuslens.plans.catalog import QUERIES

ORACLES = oracle_sql()
NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    got_cols, got = canonical(df.toPandas())
    want_cols, want = canonical(duck.sql(ORACLES[name]).df())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 150  # sf0.001 has 150 schools, fewer than the cut
    assert sorted(r["rank"] for r in rows) == list(range(1, 151))
