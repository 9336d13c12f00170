"""Every registered query against its SQL on the smallest sample."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.registry import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_of_the_reports_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    _, problem = difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert problem is None, problem


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
