"""The operators of this package as queries over the given tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sipnote.llm import (
    exact_dedup,
    fill_in_middle,
    jaccard_join,
    licenses,
    mixing,
    neighbours,
    packing,
    quality,
    secrets,
    sharding,
    toxicity,
    vector_codes,
    vector_join,
)
from sipnote.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    judged, (nats, limit, kept) = quality.classify(docs, labels, ["doc_id", "lang"])
    return judged.select(
        "doc_id",
        "lang",
        F.exp(nats).alias("perplexity"),
        F.exp(limit).alias("most_perplexity"),
        F.col(kept).alias("kept"),
    )


@query
def op2_secret_scans(spark, sf):
    return secrets.secret_digest(secrets.find_secrets(table(spark, sf, "documents")))


@query
def op3_sharding(spark, sf):
    return sharding.shard(table(spark, sf, "documents"), 8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_nearest_neighbours(spark, sf):
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op5_toxicity(spark, sf):
    scored = toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


@query
def op6_jaccard_join(spark, sf):
    return jaccard_join.linked_documents(table(spark, sf, "documents"))


@query
def op7_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"))


# Shares of tokens the languages should have.
LANGUAGE_TARGETS = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
# Documents are repeated where a language is short of tokens, and not dropped where there are many.
LEAST_RATE = 1.0


@query
def op8_mixing(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    mixed, report = mixing.mix(docs, mixing.labelled_languages(docs, labels), LANGUAGE_TARGETS, least=LEAST_RATE)
    posteriors = [F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(report["domains"])]
    return mixed.select("document.doc_id", "tokens", *posteriors, "rate", "copies")


@query
def op9_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


@query
def op10_license_scans(spark, sf):
    return licenses.license_summary(licenses.find_licenses(table(spark, sf, "documents")))


@query
def op11_fill_in_middle(spark, sf):
    return fill_in_middle.fill_in_middle(table(spark, sf, "documents"))


@query
def op12_vector_join(spark, sf):
    return vector_join.linked_vectors(table(spark, sf, "embeddings"))


@query
def op13_vector_codes(spark, sf):
    coded, codebooks = vector_codes.compress(table(spark, sf, "embeddings"))
    return coded.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.codebooks_digest(codebooks)).alias("codebooks_sha256"),
    )
