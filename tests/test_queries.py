"""Every registered query against DuckDB on whole tables."""

import math
import os

import duckdb
import pytest

from riskflow.registry import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"create view {file.split('.')[0]} as select * from '{sf_dir}/{file}'")
    return con


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql):
    got = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = normal(columns, cursor.fetchall())
    assert sorted(columns) == sorted(spark_df.columns)
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: TYPES[d] for c, d in spark_df.dtypes} == types
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert g == e


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    compare(QUERIES[name](spark, sf_dir), duck, ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE_SQL.keys()))
def test_gives_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0
