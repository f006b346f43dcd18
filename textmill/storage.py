"""Where intermediate tables go.

Tables used by several consumers are written once to the shared folder the cluster names in ``spark.checkpoint.dir``,
which cuts the lineage, survives lost executors and lets every consumer read only the columns it needs. A session that
names none (a laptop, a test) uses a folder inside its warehouse, which all its executors can reach as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024
_ROW_OVERHEAD_BYTES = 64


def checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


def staging_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/textmill/{spark.sparkContext.applicationId}"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each job begun inside the block deletes its shuffle files when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and return the table."""
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with passing_shuffles(spark):
        df.write.parquet(path, compression="zstd")
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def drop_table(table: DataFrame) -> None:
    """Delete a table of :func:`stage_table` from which nothing is read any more; others are left alone."""
    if path := table.__dict__.get("staged_path"):
        folder = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def drop_staged(spark: SparkSession, keep: set[str] = frozenset()) -> None:
    """Delete the session's staged tables but those named in ``keep`` (see :func:`staged_names`)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging_folder(spark))
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(folder):
        for status in system.listStatus(folder):
            if status.getPath().getName() not in keep:
                system.delete(status.getPath(), True)


def staged_names(spark: SparkSession) -> set[str]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging_folder(spark))
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in system.listStatus(folder)} if system.exists(folder) else set()


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted when it ends, failures included."""
    before = staged_names(spark)
    try:
        yield
    finally:
        drop_staged(spark, before)


def fits_broadcast(words: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Measure a lookup table of strings (one pass, one row back) before it may be broadcast."""
    strings = [f.name for f in words.schema.fields if f.dataType.typeName() == "string"]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in strings), F.lit(_ROW_OVERHEAD_BYTES))
    return (words.agg(F.sum(size.cast("long"))).first()[0] or 0) <= limit_bytes
