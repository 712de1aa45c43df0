import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from foldwright.session import local_session  # noqa: E402
from foldwright.staging import release  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "foldwright-tests")
    yield session
    release(session)
    session.stop()


@pytest.fixture()
def many_ranges(spark):
    """Keep small shuffles apart, so that range-wise code sees several ranges."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


@pytest.fixture()
def sf_dir():
    return SF_DIR
