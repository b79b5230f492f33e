import os

import pytest

from shelfmark.operators.skew import HOT_ROWS_SETTING
from shelfmark.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("shelfmark-tests", cores=4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def skewed(spark):
    """Treat any key with more than a handful of rows as hot."""
    spark.conf.set(HOT_ROWS_SETTING, "5")
    yield
    spark.conf.unset(HOT_ROWS_SETTING)


@pytest.fixture
def evaluate(spark):
    """Value of a column function on one string, or on null."""

    def run(function, *values):
        schema = ", ".join(f"c{i} string" for i in range(len(values)))
        row = spark.createDataFrame([tuple(values)], schema)
        from pyspark.sql import functions as F

        return row.select(function(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]

    return run
