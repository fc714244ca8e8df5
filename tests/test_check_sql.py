"""Every registered query against its check SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from supplyloom.queries.catalog import QUERIES, SQL

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return f"{type(value).__name__}:{value}"


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(SQL[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert sorted(kinds) == columns
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    places = [list(kinds).index(c) for c in columns]
    expected = sorted(tuple(plain(row[i]) for i in places) for row in result.fetchall())
    assert got == expected
