"""Every registered query against its SQL on another engine, over whole tables."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA
from contrail.plans.oracles import ORACLES
from contrail.plans.registry import QUERIES


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def as_bag(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sql, name):
    ours = QUERIES[name](spark, DATA)
    theirs = sql.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert as_bag(ours.columns, ours.collect()) == as_bag(theirs.columns, theirs.fetchall())
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
