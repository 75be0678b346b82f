"""Every registered query against its SQL counterpart, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from postlake.registry import oracles, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = {name: query for name, query in driver.queries().items() if name in queries.QUERIES}
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(queries.QUERIES) == set(oracles.ORACLES)


def test_flagship(spark):
    assert driver.entry(spark).columns == ["skill_name", "demand"]
    assert driver.entry(spark).count() == 10


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)

    def rows(table, names):
        order = sorted(range(len(names)), key=names.__getitem__)
        return sorted(tuple(repr(row[i]) for i in order) for row in table)

    assert rows(df.collect(), df.columns) == rows(result.fetchall(), columns)
