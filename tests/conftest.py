import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("orderflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A function that names fresh folders below this test's own one."""
    return lambda name: str(tmp_path / name)


@pytest.fixture
def orders(spark):
    """Rows as tuples of the seven order columns, created_at as text, to an order table."""

    def build(*rows):
        schema = (
            "order_id bigint, customer_name string, restaurant_name string, item string, "
            "amount decimal(10,2), order_status string, created_at string"
        )
        frame = spark.createDataFrame(list(rows), schema)
        return frame.withColumn("created_at", frame.created_at.cast("timestamp_ntz"))

    return build
