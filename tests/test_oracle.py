"""Every registered query against its SQL, on whole tables."""

import datetime
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registered
from shardlog.plans import delivery, reading, streaming

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


DUCK_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "binary": "BLOB",
}


OWN = {name: sql for module in (reading, delivery, streaming) for name, sql in module.ORACLES.items()}


def test_every_query_has_sql():
    queries = {name for module in (reading, delivery, streaming) for name in module.QUERIES}
    assert queries == set(OWN)
    assert queries <= set(registered.queries())


@pytest.mark.parametrize("name", list(OWN))
def test_query(spark, duck, name):
    got = registered.queries()[name](spark, SF)
    want = duck.execute(registered.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    types = {d[0]: str(d[1]) for d in want.description}
    assert {c: DUCK_TYPES[t] for c, t in got.dtypes} == types
    found, expected = rows_of(got.columns, got.collect()), rows_of(columns, want.fetchall())
    assert expected, "the check compares no rows"
    assert found == expected
