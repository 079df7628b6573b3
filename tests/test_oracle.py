"""Every registered query against its DuckDB twin (the driver's check) at sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck_conn
from sheetfold.plans.registry import QUERIES as Q

O = {k: v for k, v in E.oracle_sql().items() if k in Q}


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


def test_every_query_has_oracle():
    assert set(Q) == set(O)


@pytest.mark.parametrize("name", sorted(Q))
def test_matches_duckdb(spark, con, name):
    n, problems = compare(spark, con, name, Q[name], O[name], SF_SMALL)
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns[0] == "nombre"
