"""Every registered query against its SQL on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from workload.registry import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_names_agree():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def rounded(row):
    return repr(tuple(round(v, 9) if isinstance(v, float) else v for v in row))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(driver.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    want = sorted(rounded([row[names.index(c)] for c in columns]) for row in cursor.fetchall())
    got = sorted(rounded([row[c] for c in columns]) for row in df.collect())
    assert got == want


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns and df.count() > 0
