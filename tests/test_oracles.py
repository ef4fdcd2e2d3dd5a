"""Every registered query with an oracle matches DuckDB on the same tables."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_compare import _rows, duck

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = _rows([tuple(r) for r in df.collect()], cols)
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    assert got == _rows(cur.fetchall(), ocols)


def test_every_query_has_a_callable_and_entry_runs(spark):
    qs = entry.queries()
    assert set(ORACLES) <= set(qs)
    out = entry.entry(spark)
    assert out.count() > 0
