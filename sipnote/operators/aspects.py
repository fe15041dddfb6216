"""Aspect extraction over tables, and what is derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sipnote.functions import aspects as A
from sipnote.functions.text import tokens

LEXICON = A.AspectLexicon()


def count_columns(lexicon: A.AspectLexicon = LEXICON) -> list[str]:
    return [f"aspect_{c}" for c in lexicon.categories]


def with_aspect_counts(
    df: DataFrame, text: str, lowered_words: Column | None = None, lexicon: A.AspectLexicon = LEXICON
) -> DataFrame:
    """Add one count column per category. No shuffle; every token is looked up once.

    ``lowered_words`` are the tokens in lower case where the caller has them already.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = tokens(F.lower(whole)) if lowered_words is None else lowered_words
    # The hits are a projection of their own, so the counts read them and do not repeat them.
    found = df.withColumn("_hits", A.hit_categories(whole, words, lexicon))
    counts = {f"aspect_{c}": A.count_category(F.col("_hits"), c) for c in lexicon.categories}
    return found.withColumns(counts).drop("_hits")


def token_matches(df: DataFrame, key: str, text: str, lexicon: A.AspectLexicon = LEXICON) -> DataFrame:
    """One row per lexicon word in a text: key, category, match_text, lemma, token_index."""
    hits = A.word_hits(tokens(F.coalesce(F.col(text), F.lit(""))), lexicon)
    return _match_rows(df.select(key, F.explode(hits).alias("hit")), key)


def phrase_matches(df: DataFrame, key: str, text: str, lexicon: A.AspectLexicon = LEXICON) -> DataFrame:
    """One row per phrase that occurs in a text, however often; the index is -1."""
    hits = A.phrase_hits(F.coalesce(F.col(text), F.lit("")), lexicon)
    return _match_rows(df.select(key, F.explode(hits).alias("hit")), key)


def all_matches(df: DataFrame, key: str, text: str, lexicon: A.AspectLexicon = LEXICON) -> DataFrame:
    return _match_rows(df.select(key, F.explode(A.aspect_hits(F.col(text), lexicon)).alias("hit")), key)


def _match_rows(exploded: DataFrame, key: str) -> DataFrame:
    hit = F.col("hit")
    return exploded.select(
        key,
        hit["category"].alias("category"),
        hit["text"].alias("match_text"),
        hit["lemma"].alias("lemma"),
        hit["index"].alias("token_index"),
    )


def with_nested_aspects(df: DataFrame, text: str, target: str = "aspects", lexicon: A.AspectLexicon = LEXICON) -> DataFrame:
    """Add a map of category -> (count, matches) with every category."""
    found = df.withColumn("_hits", A.aspect_hits(F.col(text), lexicon))
    return found.withColumn(target, A.nested_aspects(F.col("_hits"), lexicon)).drop("_hits")


def aspect_coverage(processed: DataFrame, lexicon: A.AspectLexicon = LEXICON) -> DataFrame:
    """Reviews that mention each aspect, number and percent; one aggregation."""
    counted = [F.coalesce(F.sum((F.col(c) > 0).cast("long")), F.lit(0)).alias(c) for c in count_columns(lexicon)]
    totals = processed.agg(F.count("*").alias("total"), *counted)
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("aspect"), F.col(f"aspect_{c}").alias("reviews"))
                for c in lexicon.categories
            ]
        )
    )
    share = F.round(F.col("reviews") * 100.0 / F.when(F.col("total") > 0, F.col("total")), 6)
    return totals.select("total", rows.alias("row")).select("row.*", "total").withColumn("percent", share)


def top_styles(processed: DataFrame, count_column: str, n: int = 5) -> DataFrame:
    """The styles with most mentions per review."""
    mean = F.round(F.avg(count_column), 6).alias("mean_mentions")
    return processed.groupBy("style").agg(mean).orderBy(F.desc("mean_mentions"), "style").limit(n)


def aspect_lemmas(df: DataFrame, key: str, text: str, lexicon: A.AspectLexicon = LEXICON) -> DataFrame:
    """The matched lemmas per text and category, in order, for categories that occur.

    The matches of a text are already one array, so they are sorted out in the row.
    """
    found = df.select(key, A.aspect_hits(F.col(text), lexicon).alias("_hits"))

    def of(category: str) -> Column:
        hits = F.filter(F.col("_hits"), lambda h: h["category"] == category)
        return F.struct(F.lit(category).alias("category"), F.transform(hits, lambda h: h["lemma"]).alias("lemmas"))

    entries = found.select(key, F.explode(F.array(*[of(c) for c in lexicon.categories])).alias("e"))
    return entries.where(F.size("e.lemmas") > 0).select(
        key, "e.category", F.size("e.lemmas").alias("n"), F.array_join("e.lemmas", ",").alias("lemmas")
    )


def aspect_pairs(df: DataFrame, text: str, lexicon: A.AspectLexicon = LEXICON) -> DataFrame:
    """Distinct (category, surface text, lemma) with the number of matches."""
    hits = df.select(F.explode(A.aspect_hits(F.col(text), lexicon)).alias("hit"))
    return hits.groupBy(
        F.col("hit.category").alias("category"), F.col("hit.text").alias("match_text"), F.col("hit.lemma").alias("lemma")
    ).agg(F.count("*").alias("n"))
