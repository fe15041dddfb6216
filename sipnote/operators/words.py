"""Word-by-word replacement from a table of any size."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sipnote.functions.text import collapse_whitespace, split_words
from sipnote.operators.lookup import BROADCAST_BYTES, lookup


def replace_words(
    df: DataFrame,
    table: DataFrame,
    key: str,
    source: str,
    target: str,
    lookup_form=lambda word: word,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``target``: ``source`` with each word replaced where the table knows its form.

    ``table`` has the columns form and replacement, one row per form. The distinct forms of a text
    are looked up; only those the table knows are shuffled, gathered as pairs per key, and
    replaced in the row. Every row is kept, with null and repeated keys too: the pairs only say what
    becomes of a form, so rows that share a key may share them.
    """
    words = split_words(F.coalesce(F.col(source), F.lit("")))
    forms = F.array_distinct(F.transform(words, lookup_form))
    # explode would add a filter on the size of the array below, and compute the forms twice.
    listed = df.select(key, F.explode_outer(forms).alias("form"))
    hits = lookup(listed, table, "form", [key], limit).where("replacement IS NOT NULL")
    pairs = F.sort_array(F.collect_set(F.struct("form", "replacement")))
    maps = hits.groupBy(F.col(key).alias("_key")).agg(pairs.alias("_pairs"))

    joined = df.drop(target).join(maps, F.col(key).eqNullSafe(F.col("_key")), "left")
    joined = joined.withColumn("_words", collapse_whitespace(F.coalesce(F.col(source), F.lit(""))))
    its_forms = F.array_join(F.transform(F.split("_words", " "), lookup_form), " ")
    none = F.lit(None).cast("string")
    its_forms = F.when(F.col("_pairs").isNull(), none).otherwise(its_forms)
    changed = _replaced("_words", its_forms, F.col("_pairs.form"), F.col("_pairs.replacement"))
    return joined.withColumn(target, changed).drop("_key", "_pairs", "_words")


def _replaced(text: str, forms: Column, known: Column, replacements: Column) -> Column:
    """Words of a text replaced where their form, at the same place among ``forms``, is known."""

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, forms: pd.Series, known: pd.Series, replacements: pd.Series) -> pd.Series:
        def one(text, own, known, replacements):
            if own is None or known is None:
                return text
            table = dict(zip(known, replacements))
            return " ".join([table.get(f, w) for w, f in zip(text.split(" "), own.split(" "), strict=True)])

        return pd.Series([one(*row) for row in zip(texts, forms, known, replacements)], dtype="object")

    return replaced(text, forms, known, replacements)
