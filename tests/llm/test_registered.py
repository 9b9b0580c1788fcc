"""The registered queries of the operators against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from tests.test_queries import OPTIONAL, SQL_TYPES, TABLES, in_order

QUERIES, ORACLES = ({k: v for k, v in given.items() if OPTIONAL.match(k)} for given in (entry_point.queries(), entry_point.oracle_sql()))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    found = in_order(df.select(names).collect())
    result = duck.execute(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})")
    types = {column[0]: str(column[1]) for column in result.description}
    assert {c: SQL_TYPES[kind] for c, kind in df.dtypes} == types
    assert found == in_order(result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_returns_a_row_for_each_document(spark, sf_dir, name):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    n = QUERIES[name](spark, sf_dir).count()
    assert n == documents or name == "pipeline" and n > 0
