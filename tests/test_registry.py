"""Every registered query against its SQL in DuckDB, over the whole small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, connect  # noqa: E402
from conftest import SF  # noqa: E402
from faremill.registry import oracle  # noqa: E402
from faremill.registry.queries import REGISTRY  # noqa: E402

QUERIES, ORACLE = dict(REGISTRY), oracle.sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    same, detail = compare(spark, duck, name, QUERIES[name], ORACLE[name], SF)
    assert same, detail


def test_entry(spark):
    assert entry.entry(spark).count() > 2000
