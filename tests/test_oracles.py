"""Every query beside its SQL on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def _shown(value):
    if isinstance(value, float):
        return "float", "nan" if math.isnan(value) else repr(round(value, 6))
    return type(value).__name__, str(value)


def _table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_shown(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    got, expected = _table(df.collect(), df.columns), _table(result.fetchall(), columns)
    assert len(got) == len(expected)
    assert got == expected


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
