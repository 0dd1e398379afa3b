"""Every registered query against its SQL on the smallest tables."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import normal


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf_dir, engine, name):
    df = entry.queries()[name](spark, sf_dir)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = engine.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(rows, df.columns) == normal(result.fetchall(), columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["phrase", "cnt"] and df.count() == 20


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(re.fullmatch(r"[a-z0-9_]+", name) for name in entry.queries())
