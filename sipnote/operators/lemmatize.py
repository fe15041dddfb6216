"""Lemmas from a table too large for a literal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sipnote.operators.lookup import BROADCAST_BYTES
from sipnote.operators.words import replace_words


def lemmatize_with_table(
    df: DataFrame, lemmas: DataFrame, key: str, source: str, target: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Same result as ``functions.text.lemmatize_words``, from a (form, lemma) table."""
    table = lemmas.groupBy("form").agg(F.min("lemma").alias("replacement"))
    return replace_words(df, table, key, source, target, F.lower, limit)
