"""Scoring a text column with any Python model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sipnote.operators.lookup import BROADCAST_BYTES, lookup
from sipnote.session import written

STORE = "model string, digest string, label string"

Scorer = Callable[[list[str]], list[str]]


def score_batches(
    df: DataFrame, text: str, target: str, load_scorer: Callable[[], Scorer], batch_size: int = 64
) -> DataFrame:
    """Add ``target``: the label the scorer gives each text; a null text is scored as ''.

    ``load_scorer`` runs once per task, so a heavy model is not loaded per row or per batch.
    The scorer gets lists of at most ``batch_size`` whole texts. Only the text column goes
    through Arrow; the others stay in the JVM.
    """

    @F.pandas_udf("string")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = load_scorer()
        for texts in batches:
            values = texts.fillna("").tolist()
            labels: list[str] = []
            for start in range(0, len(values), batch_size):
                labels.extend(scorer(values[start : start + batch_size]))
            yield pd.Series(labels, dtype="object")

    return df.withColumn(target, score(F.col(text)))


def stored_scores(spark: SparkSession, store: str, model: str) -> DataFrame:
    """The scores of one model in a store: (digest, label), a digest once."""
    scores = spark.read.schema(STORE).parquet(store).where(F.col("model") == model)
    return scores.groupBy("digest").agg(F.min("label").alias("label"))


def score_with_store(
    df: DataFrame,
    key: str,
    text: str,
    target: str,
    load_scorer: Callable[[], Scorer],
    store: str,
    model: str,
    batch_size: int = 64,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``score_batches`` that scores each distinct text once, over all runs that share a store.

    ``store`` is the folder of a table (model, digest, label) that all executors reach; it is made
    where it is missing, and ``model`` names the model and its version. Texts go by their SHA-256.
    Digests alone decide what is new; only new texts are shuffled, their copies put together
    before, and sorted by length in each partition, so that a batch holds texts of like length.
    The new scores are appended in one job: a run that fails leaves none, or all, and the next goes on.

    Every row is kept, with null and repeated keys too. A null text is scored as ''. A label that
    is null is stored and not asked for again. Runs at the same time may score a text twice; the
    smaller label counts.
    """
    spark = df.sparkSession
    # An empty append makes the folder.
    spark.createDataFrame([], STORE).write.mode("append").parquet(store)
    digested = df.drop(target).withColumn("_digest", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    known = stored_scores(spark, store, model).select(F.col("digest").alias("_digest"))
    unknown = digested.select("_digest").distinct().join(known, "_digest", "left_anti")
    unknown = written(unknown.withColumn("_new", F.lit(1)), "new-digests")
    whole = digested.select(F.col(key).alias("_key"), "_digest", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    new = lookup(whole, unknown, "_digest", ["_key"], limit).where("_new IS NOT NULL")
    once = new.groupBy("_digest").agg(F.first("_text").alias("_text")).sortWithinPartitions(F.length("_text"))
    scored = score_batches(once, "_text", "label", load_scorer, batch_size)
    scored.select(F.lit(model).alias("model"), F.col("_digest").alias("digest"), "label").write.mode("append").parquet(store)
    scores = stored_scores(spark, store, model).select(F.col("digest").alias("_digest"), F.col("label").alias(target))
    labelled = lookup(digested, written(scores, "scores"), "_digest", [key], limit)
    return labelled.select(*[c for c in df.columns if c != target], target)
