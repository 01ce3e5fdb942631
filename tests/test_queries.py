"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerferry.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def normal(value):
    if isinstance(value, float) and not math.isnan(value):
        return repr(round(value, 6))
    return repr(value)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql()[name]
    columns = sorted(frame.columns)
    result = duck.execute(f"SELECT {', '.join(columns)} FROM ({sql})")
    expected = sorted(tuple(map(normal, row)) for row in result.fetchall())
    got = sorted(tuple(normal(row[c]) for c in columns) for row in frame.collect())
    assert len(got) > 0
    assert got == expected
    described = {r[0]: str(r[1]) for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: TYPES[t] for c, t in frame.dtypes} == described
