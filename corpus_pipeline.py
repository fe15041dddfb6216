"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept, as a written table, and decides on all of
them. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sipnote.llm import exact_dedup, jaccard_join, mixing, packing, quality
from sipnote.llm.common import table
from sipnote.llm.queries import LANGUAGE_TARGETS, LEAST_RATE
from sipnote.session import written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose perplexity is above the threshold of their language and size."""
    judged, (_, _, kept) = quality.classify(docs, table(spark, sf_dir, "labels"))
    return judged.where(F.col(kept)).select(*docs.columns)


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep the document with the largest id."""
    return exact_dedup.without_duplicates(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 or more of their shingles of five words, keep that with the smallest id."""
    return jaccard_join.without_near_copies(docs, words=5, percent=80)


def mixed_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that the languages have their shares of tokens; none is dropped."""
    labelled = mixing.labelled_languages(docs, table(spark, sf_dir, "labels"))
    mixed, _ = mixing.mix(docs, labelled, LANGUAGE_TARGETS, docs.columns, least=LEAST_RATE)
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.where("copies > 0").select("document", times).select("document.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", no_exact_copies),
    ("near_dedup", no_near_copies),
    ("mixing", mixed_languages),
    ("packing", packed),
]

# Perplexities, components and packings are not for SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
