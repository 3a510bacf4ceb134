"""Every query agrees with its SQL, and the driver contract holds."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_catalog import compare, connect
from tidemark.plans.catalog import CATALOG

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(CATALOG) <= set(entry.oracle_sql()) and set(CATALOG) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {
        "id", "CompanyId", "stage", "amount", "modified", "watermark", "sync_type", "records_processed",
    }
