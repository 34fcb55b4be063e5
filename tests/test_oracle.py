"""Every registered query against its DuckDB statement (order-insensitive)."""

import pytest

import __spark_entry__ as E
from martforge.queries import QUERIES as MART_QUERIES
from martforge.queries import oracle
from tests.oracle_compare import compare, duck, type_diff

QUERIES = dict(MART_QUERIES)
SQL = oracle()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    assert type_diff(df, SQL[name], con) == {}
    r = compare(df, SQL[name], sf_dir, con)
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["id", "ano", "mes", "qtde_vendida", "valor_total_real",
                          "valor_total_esperado", "data_atualizacao"]
