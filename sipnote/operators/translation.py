"""Translation from a memory table, and tables of mixed language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sipnote.functions.fixed_values import FALLBACK_JAPANESE
from sipnote.functions.language import language_flag, needs_translation
from sipnote.operators.lookup import BROADCAST_BYTES, fits_broadcast, lookup
from sipnote.operators.ranking import first_n, in_first_n, in_sample, label_table


def translate_from_memory(
    df: DataFrame, memory: DataFrame, key: str = "review_id", text: str = "text", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Replace the texts that need it by their translation.

    ``memory`` has source_text and translated. A text without a translation, or with an empty
    one, stays. Rows that need none take no part in a shuffle. Copies of one text may be any
    share of the table: a small memory is broadcast, a large one joined with split hot keys.
    """
    table = (
        memory.where(F.col("translated") != "")
        .groupBy(F.col("source_text").alias("_source"))
        .agg(F.max("translated").alias("_translated"))
    )
    needed = needs_translation(F.col(text))
    result = F.coalesce("_translated", text).alias(text)
    columns = [result if c == text else F.col(c) for c in df.columns]
    keyed = df.withColumn("_source", F.when(needed, F.col(text)))
    if fits_broadcast(table, limit):
        return keyed.join(F.broadcast(table), "_source", "left").select(*columns)
    translated = lookup(keyed.where("_source IS NOT NULL"), table, "_source", [key], limit)
    return translated.select(*columns).unionByName(df.where(~needed))


def missing_translations(df: DataFrame, memory: DataFrame, text: str = "text") -> DataFrame:
    """The distinct texts that need a translation and have none: the work list of a translator."""
    known = memory.where(F.col("translated") != "").select(F.col("source_text"))
    todo = df.where(needs_translation(F.col(text))).select(F.col(text).alias("source_text")).distinct()
    return todo.join(known, "source_text", "left_anti")


def language_counts(df: DataFrame, text: str = "text") -> DataFrame:
    return df.groupBy(language_flag(F.col(text)).alias("language")).agg(F.count("*").alias("n"))


def overlay_sources(df: DataFrame, key: str, n: int, text: str = "text", max_chars: int = 300) -> DataFrame:
    """The first ``n`` texts, cut to ``max_chars``, to be handed to a translator."""
    return first_n(df, key, n).select(key, F.left(F.col(text), F.lit(max_chars)).alias(text))


def mixed_language(
    df: DataFrame,
    overlay: DataFrame,
    n: int,
    key: str = "review_id",
    text: str = "text",
    fallback: str = FALLBACK_JAPANESE,
    sampled: bool = False,
    seed: int = 42,
) -> DataFrame:
    """The whole table with ``n`` rows in Japanese, and a ``language`` column.

    The first ``n`` rows by key, or a seeded sample of ``n``, take their text from ``overlay``
    (key and text, one row per key), or the fallback where it has none. The condition that
    chooses rows also cuts the overlay to their keys before it is looked up.
    """
    marked = df.withColumn("_chosen", in_sample(df, key, n, seed) if sampled else in_first_n(df, key, n))
    chosen = F.col("_chosen")
    keys = label_table(marked.where(chosen).select(key).distinct())  # at most ``n``
    needed = overlay.join(keys, key, "left_semi").select(key, F.col(text).alias("_overlay"))
    joined = lookup(marked, needed, key, [key])
    new_text = F.when(chosen, F.coalesce("_overlay", F.lit(fallback))).otherwise(F.col(text))
    columns = [new_text.alias(c) if c == text else F.col(c) for c in df.columns]
    return joined.select(*columns, F.when(chosen, "ja").otherwise("en").alias("language"))
