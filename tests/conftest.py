import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(request, spark):
    """Run a test under both session zones."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)
