"""The queries that SQL can express against their SQL on the given tables."""

import os

import duckdb
import pytest

from tidegate.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents pages embeddings benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    want = sorted(repr([row[names.index(c)] for c in df.columns]) for row in cursor.fetchall())
    assert sorted(repr(list(row)) for row in df.collect()) == want
