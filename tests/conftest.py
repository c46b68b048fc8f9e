import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a frame from rows; text in timestamp columns is parsed."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def build(rows, schema):
        wanted = spark.createDataFrame([], schema).schema
        loose = T.StructType([
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
            for f in wanted.fields
        ])
        df = spark.createDataFrame(rows, loose)
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])

    return build
