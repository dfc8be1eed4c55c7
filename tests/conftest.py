import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

AS_OF = datetime(2024, 3, 31, 18, 30)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tillwatch-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame of literal rows; times without zone, money as decimals."""

    def make(schema, rows):
        schema = schema.replace(" ts", " timestamp_ntz").replace(" money", " decimal(18,2)")
        return spark.createDataFrame([tuple(row) for row in rows], schema)

    return make


def at(text):
    return datetime.fromisoformat(text)


def cash(text):
    return Decimal(text)


def rows(df):
    """Rows as plain tuples in a stable order."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [str(cell) for cell in row])
