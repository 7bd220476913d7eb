"""Every registered query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from conftest import TABLES

import __spark_entry__ as driver
from pagefold.plans.oracles import ORACLES
from pagefold.plans.queries import QUERIES

NO_SQL = {"corrected_texts"}


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return float(f"{value:.9g}") if isinstance(value, float) else value


def test_every_query_is_checked():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert set(driver.oracle_sql()) <= set(driver.queries()) and set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, tables, name):
    cursor = tables.execute(driver.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    expected = sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    frame = driver.queries()[name](spark, TABLES)
    assert sorted(frame.columns) == sorted(names)
    rows = frame.select(sorted(frame.columns)).collect()
    assert sorted((tuple(plain(v) for v in r) for r in rows), key=repr) == expected


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_query_without_sql(spark, name):
    assert driver.queries()[name](spark, TABLES).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
