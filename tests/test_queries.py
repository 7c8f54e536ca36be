"""Every registered query against its SQL twin, or for rows where it has none."""

import pytest

import __spark_entry__ as entry
from tests.harness import differences, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, connection, name):
    assert differences(spark, connection, FOLDER, entry.queries()[name], entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_has_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["site_id", "locs_in_fence"]
