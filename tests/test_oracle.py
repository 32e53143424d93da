"""Every registered query against its SQL twin, on the smallest data set."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.11g}"
    return str(value)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, SF)
    rows = df.collect()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    got = sorted(tuple(shown(r[c]) for c in order) for r in rows)
    want = sorted(tuple(shown(r[columns.index(c)]) for c in order) for r in cursor.fetchall())
    assert got == want


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "well_id" and df.count() > 0


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
