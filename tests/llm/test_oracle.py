"""Queries of the subpackage against their SQL."""

import glob
import os

import duckdb
import pytest

from lakelayers.llm.queries import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    found = duck.execute(ORACLE[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr) and got
    assert {c: TYPES[t] for c, t in df.dtypes} == {c[0]: str(c[1]) for c in found.description}
