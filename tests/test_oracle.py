"""Every registered query against its SQL oracle in DuckDB (sf0.001),
plus the driver contract of ``__spark_entry__``."""

import pytest

import __spark_entry__ as entry
from tools.check_oracles import compare, duck_connection

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    ok, msg = compare(df, con, ORACLES[name])
    assert ok, msg


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "id"
    assert set(ORACLES) <= set(entry.queries())
