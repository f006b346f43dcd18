"""Document collections as ``doc(source, doc_id, text)``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.rank import MAX_MERGED_ROWS, near_digest_end, top_n
from textmill.storage import fits_broadcast, stage_table


@dataclass(frozen=True)
class DocumentSource:
    """A parquet collection (path or glob) with one text column.

    Without ``id_cols`` a document is named by its file and row number. ``smoke_path`` is read instead of ``path``
    when only a limited number of documents is wanted.
    """

    name: str
    path: str
    text_col: str = "text"
    id_cols: tuple[str, ...] = ()
    smoke_path: str | None = None
    enabled: bool = True

    def path_read(self, smoke: bool = False) -> str:
        return self.smoke_path if smoke and self.smoke_path else self.path


def read_documents(spark: SparkSession, source: DocumentSource, smoke: bool = False) -> DataFrame:
    """Scan one collection: only the text and the identity columns are read."""
    ids = [F.col(c).cast("string") for c in source.id_cols] or [
        F.col("_metadata.file_path"),
        F.col("_metadata.row_index").cast("string"),
    ]
    return spark.read.parquet(source.path_read(smoke)).select(
        F.lit(source.name).alias("source"),
        document_id(ids).alias("doc_id"),
        F.col(source.text_col).alias("text"),
    )


def document_id(ids: Sequence[Column]) -> Column:
    """Parts joined by colons, none lost: inside a part of several, colons and backslashes are escaped, and a null is
    ``\\N``."""
    if len(ids) > 1:
        ids = [F.replace(F.replace(i, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:")) for i in ids]
    return F.concat_ws(":", *(F.coalesce(i, F.lit("\\N")) for i in ids))


def null_documents(spark: SparkSession, sources: Sequence[DocumentSource], smoke: bool = False) -> DataFrame:
    """(source, n, longest): the documents without text that :func:`union_sources` leaves out, and the bytes of the
    longest text.
    """
    docs = reduce(DataFrame.unionByName, (read_documents(spark, s, smoke) for s in sources if s.enabled))
    return docs.groupBy("source").agg(
        F.count_if(F.col("text").isNull()).alias("n"), F.max(F.octet_length("text")).alias("longest")
    )


def union_sources(spark: SparkSession, sources: Sequence[DocumentSource], smoke: bool = False) -> DataFrame:
    """All enabled collections; documents without text are left out."""
    enabled = [s for s in sources if s.enabled]
    if not enabled:
        raise ValueError("no document source is enabled")
    if len({s.name for s in enabled}) < len(enabled):
        raise ValueError("two document sources have one name")
    docs = reduce(DataFrame.unionByName, (read_documents(spark, s, smoke) for s in enabled))
    return docs.filter(F.col("text").isNotNull())


def take_by_hash(docs: DataFrame, n: int) -> DataFrame:
    """The ``n`` documents with the largest md5 of their text; copies are told apart by source and id.

    One pass over the texts writes their digests; only those near the end of the range are ordered, and the texts are
    picked out by a semi join afterwards.
    """
    ids = stage_table(docs.select("source", "doc_id", F.md5("text").alias("_digest")), "digests")
    near = near_digest_end(ids, n, largest=True)
    chosen = top_n(near, [F.desc("_digest"), F.asc("source"), F.asc("doc_id")], n).drop("_digest")
    small = n <= MAX_MERGED_ROWS or fits_broadcast(chosen)
    return docs.join(F.broadcast(chosen) if small else chosen, ["source", "doc_id"], "left_semi")


TASKS_PER_CORE = 4


def spread(docs: DataFrame, cores: int | None = None) -> DataFrame:
    """Give every core work where a collection has few, large row groups; a scan with enough tasks is left alone.

    Extraction does far more work per byte than the scan, so shuffling a small collection first pays off. Several tasks
    per core even out long documents. ``docs`` must be a plain scan: counting the partitions of a shuffle would run it.
    """
    cores = cores or docs.sparkSession.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() >= cores:
        return docs
    return docs.repartition(cores * TASKS_PER_CORE, "source", "doc_id")
