import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyward.context import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallyward-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session
    session.stop()


@pytest.fixture()
def folder():
    """A new folder for each test that writes."""
    return tempfile.mkdtemp(prefix="tallyward-test-")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
