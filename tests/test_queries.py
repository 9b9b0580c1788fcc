"""Every registered query with SQL is compared with DuckDB on the smallest tables."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry_point

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# The optional operators are tested in tests/llm.
OPTIONAL = re.compile(r"op\d+_|pipeline$")
QUERIES, ORACLES = ({k: v for k, v in given.items() if not OPTIONAL.match(k)} for given in (entry_point.queries(), entry_point.oracle_sql()))
SQL_TYPES = {"boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def in_order(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    found = in_order(df.select(names).collect())
    result = duck.execute(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})")
    types = {column[0]: str(column[1]) for column in result.description}
    assert {c: SQL_TYPES[kind] for c, kind in df.dtypes} == types
    assert found == in_order(result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"training_scale_sweep", "train_gbt"}))
def test_query_without_sql_returns_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) == 20 and rows[0].n >= rows[-1].n


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
