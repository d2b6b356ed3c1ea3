import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["plain", "salted"])
def skew(request, spark):
    """Run a test with and without salting; salted lets a task have few rows."""
    if request.param == "salted":
        spark.conf.set("spark.cladeweave.skew.rows", "100")
    yield request.param
    spark.conf.unset("spark.cladeweave.skew.rows")


@pytest.fixture(scope="session")
def smallest():
    return f"{TESTDATA}/sf0.001"
