"""Every registered query against its oracle SQL (DuckDB) on the smallest
scale factor: same column names, row count and multiset of rows."""

import pytest

import __spark_entry__ as E
from strata.oracle import QUERIES
from strata.queries import REGISTRY
from tools.oracle_check import duck, rows_of

from given_tables import SF_SMALL

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(REGISTRY)
    assert set(REGISTRY) <= set(E.oracle_sql()) & set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    d_cols, d_rows = rows_of([c[0] for c in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["series_id", "class_text", "sector_name", "measure_text", "duration_text",
                          "year", "value_sum"]
    assert df.count() > 0
