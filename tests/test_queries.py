"""Registered queries against their SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from workload.check import compare, connect
from workload.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql_agrees(spark, name):
    assert compare(name, spark, connect(FOLDER), FOLDER).startswith("ok")
