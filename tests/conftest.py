import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tasteloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tasteloom-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def ratings(spark):
    """Four users, four products, one repeated pair."""
    rows = [
        (1, 10, 5.0, 100), (1, 11, 3.0, 200), (1, 10, 2.0, 300),
        (2, 10, 4.0, 100), (2, 12, 0.5, 150), (3, 13, 5.0, 50), (4, 10, 1.0, 10),
    ]
    return spark.createDataFrame(rows, "user_id long, product_id long, rating double, ts long")
