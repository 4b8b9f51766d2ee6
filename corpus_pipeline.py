"""A cleaning pipeline for training documents: each stage reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortline.llm.common import table
from cohortline.llm.decontaminate import drop_contaminated
from cohortline.llm.exact_dedup import drop_exact_duplicates
from cohortline.llm.pieces import encode_documents
from cohortline.llm.quality import drop_low_quality
from cohortline.llm.simhash import drop_near_duplicates
from cohortline.plans.durable import freeze


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the ids of the pieces of every text."""
    return encode_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", pieces),
]
# The classifier and the fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir))
    return docs
