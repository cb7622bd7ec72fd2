"""Every query with SQL gives the rows that the SQL gives, at the smallest scale."""

from __future__ import annotations

import datetime
import os

import duckdb
import pytest

from attestry import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, datetime.datetime) and v.time() == datetime.time():
        v = v.date()
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=str)
    result = duck.execute(SQL[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(_plain(r[i]) for i in at) for r in result.fetchall()), key=str)


def test_no_nested_loop(spark):
    for name in ("bitemporal_verdict", "name_mentions", "snapshot_diff"):
        plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
        assert "PythonUDF" not in plan and "MapInArrow" not in plan
