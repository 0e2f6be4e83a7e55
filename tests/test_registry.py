"""Every registered query against its SQL, over the whole tables of the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


NAMES = [name for name in entry.queries() if name not in entry.ADDED_QUERIES]


def test_every_query_has_sql():
    assert set(NAMES) == set(entry.oracle_sql()) - set(entry.ADDED_SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, connection, name):
    problems = compare(spark, connection, SF, entry.queries()[name], entry.oracle_sql()[name])
    assert [p for p in problems if not p.startswith("note")] == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
