"""Every registered query against its SQL counterpart, at the smallest scale."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from workload import oracles as workload_oracles, queries as workload_queries
from tools.verify import TABLES, kind

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = workload_queries.QUERIES, workload_oracles.ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_each_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    theirs = Counter(tuple(kind(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    assert Counter(tuple(kind(row[c]) for c in columns) for row in df.collect()) == theirs


def test_flagship(spark):
    assert entry_point.entry(spark).count() > 0


def test_each_kind_of_control_fails(spark):
    status = {r.check_id: r.status for r in QUERIES["check_suite_failing"](spark, SF).collect()}
    assert status.pop("DUP_CUSTOMERS") == "WARN"
    passed = {check for check, s in status.items() if s != "FAIL"}
    assert passed == {"REQ_CUSTOMERS", "REQ_SALES_ORDERS"}
