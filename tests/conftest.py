import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("textmill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{folders}/shared")
        .config("spark.sql.warehouse.dir", f"file://{folders}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a column function to a list of values."""
    from pyspark.sql import functions as F

    def run(fn, values, type_name="string"):
        rows = list(enumerate(values))
        df = spark.createDataFrame(rows, f"i int, v {type_name}").repartition(4)
        return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
