"""The training-data pipeline: quality rules, near-duplicates, decontamination, personal data, mixing.

Each stage takes the documents its predecessor kept and returns documents; the last returns the mix. Between stages
documents are written as Parquet and read again, so a lost executor costs at most its tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import decontaminate, minhash, mixing, pii, quality_rules
from textmill.llm.common import n_words
from textmill.storage import stage_table

SHINGLE, PERCENT = 5, 80  # of the near-duplicate stage; op2_minhash has its own


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without boilerplate lines."""
    return _counted(quality_rules.keep_documents(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near-duplicates."""
    return minhash.keep_first(docs, percent=PERCENT, shingle=SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those with nothing else go."""
    cut = decontaminate.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _counted(cut.filter(n_words(F.col("text")) > 0))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _counted(pii.mask(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken."""
    return mixing.emit(docs)


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with its n_chars made true again."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("mixing", mix),
]
# A trained tagger decides in the fourth stage, which SQL can't express; the pipeline is tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix made of all documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
