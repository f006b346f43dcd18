import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) or (id, text, source) rows."""

    def make(rows, schema=DOCS):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def clashing():
    """Add columns whose names an operator might use itself."""
    from pyspark.sql import functions as F

    names = ("id", "host", "key", "content", "size", "t", "anchor", "component", "n_words", "kept", "place", "spans")

    def add(df):
        return df.select(*(F.lit(None).cast("int").alias(n) for n in names), *df.columns)

    return add
