"""Every registered query with a SQL oracle must match DuckDB (sf0.001)."""

import pytest

import __spark_entry__ as ent
from tests.oracle_harness import compare, duck
from tests.conftest import SF_SMALL

SQL = ent.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sp = ent.queries()[name](spark, SF_SMALL).toPandas()
    dk = con.execute(SQL[name]).df()
    ok, msg = compare(name, sp, dk)
    assert ok, msg


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() >= 0
    assert "p_value" in df.columns
