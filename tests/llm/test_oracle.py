"""The corpus queries that SQL can express, against that SQL on whole tables."""

import os
from collections import Counter

import duckdb
import pytest

from shardlog.llm import queries

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE"}


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert got.columns == columns
    assert {c: TYPES[t] for c, t in got.dtypes} == {d[0]: str(d[1]) for d in want.description}
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())
