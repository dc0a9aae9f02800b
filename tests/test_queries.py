"""Every query of the catalogue against its SQL, on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from textloom.plans import catalogue, oracle
from tests.compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(oracle.SQL)
    assert catalogue.QUERIES.items() <= entry.queries().items()
    assert oracle.SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert differences(catalogue.QUERIES[name](spark, FOLDER), duck, oracle.SQL[name]) == ""


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["nested_filter"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "EqualTo(event_type,purchase)" in plan
    scan = entry.queries()["last_message"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,role:string,text:string>" in scan
