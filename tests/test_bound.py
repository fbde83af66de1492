"""Every bound query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from bindings.core import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


def comparable(rows):
    def text(v):
        if v is None:
            return "\0"
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return str(v)

    return sorted(tuple(text(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, sql, name):
    found = driver.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    result = sql.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert comparable(found.select(*columns).collect()) == comparable(expected)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(driver.queries())
    assert set(REGISTRY) <= set(driver.oracle_sql())
