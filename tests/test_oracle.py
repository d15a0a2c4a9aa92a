"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
from snaplake import queries as Q  # noqa: E402

SQL = Q.ORACLE
QUERIES = {name: fn for name, fn in E.queries().items() if name in Q.SPARK}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, ns, nd = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert not problems, problems
    assert ns == nd


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["mes_referencia", "uf", "cod_cnae_principal"]
