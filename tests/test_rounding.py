"""Two decimals as Python formats them."""

import pytest
from pyspark.sql import functions as F

from textmill.functions.rounding import two_decimal_text, two_decimals


@pytest.mark.parametrize("lines", [7, 20_000, 40_000])
def test_percentiles_equal_python(spark, lines):
    values = [100.0 * (1.0 - rank / float(lines)) for rank in range(lines)]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = df.select("p", two_decimal_text(F.col("p")).alias("text"), two_decimals(F.col("p")).alias("value")).collect()
    assert all(r.text == f"{r.p:.2f}" and r.value == float(f"{r.p:.2f}") for r in got)


def test_ties_and_nulls(spark):
    values = [0.125, 0.375, 2.5, 0.005, 0.015, 99.995, 1.0, 0.0, None]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = [r.text for r in df.coalesce(1).select(two_decimal_text(F.col("p")).alias("text")).collect()]
    assert got == [None if v is None else f"{v:.2f}" for v in values]
