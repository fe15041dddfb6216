"""Lemmas of words that no table holds, by suffix rules learned from a lemma table.

A rule says what becomes of an ending: (suffix, replacement). It is learned from all forms of the table
with that ending, those that stay as they are included, and holds if most of them agree. The longest
ending of a word that has a rule decides. Both sides meet by equi-joins on endings: a word is listed
under its own few endings, never compared with other words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sipnote.functions.text import split_words
from sipnote.operators.lookup import BROADCAST_BYTES, lookup
from sipnote.operators.words import replace_words
from sipnote.session import written

LONGEST = 5
# Letters that have to stay in front of an ending.
STEM = 2
RULED = "^[a-z]{3,}$"


def _endings(word: Column, longest: int) -> Column:
    """Lengths of the endings of a word of three letters or more."""
    return F.sequence(F.lit(1), F.least(F.lit(longest), F.length(word) - STEM))


def _one_lemma(lemmas: DataFrame) -> DataFrame:
    return lemmas.groupBy("form").agg(F.min("lemma").alias("lemma"))


def suffix_rules(lemmas: DataFrame, longest: int = LONGEST, least: int = 2, percent: int = 60) -> DataFrame:
    """(suffix, replacement, agreeing, seen) from a (form, lemma) table; a lemma is a form of itself.

    A rule needs ``least`` forms that agree, and ``percent`` of all forms with its ending. Ties go to the
    replacement that sorts first. Forms that are null, short, or not of the letters a to z teach nothing.
    """
    known = _one_lemma(lemmas)
    bases = known.select(F.col("lemma").alias("form")).distinct().join(known, "form", "left_anti")
    pairs = known.unionByName(bases.withColumn("lemma", F.col("form"))).where(F.col("form").rlike(RULED))
    cut = pairs.select("form", "lemma", F.explode(_endings(F.col("form"), longest)).alias("k"))
    stem = F.left("form", F.length("form") - F.col("k"))
    # A lemma that does not begin with the stem, as of an irregular form, counts as a form that does not agree.
    replacement = F.when(F.col("lemma").startswith(stem), F.substr("lemma", F.length(stem) + 1))
    counts = cut.select(F.right("form", F.col("k")).alias("suffix"), replacement.alias("replacement"))
    counts = counts.groupBy("suffix", "replacement").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.when(F.col("replacement").isNotNull(), F.struct((-F.col("n")).alias("rank"), "replacement")))
    rules = counts.groupBy("suffix").agg(F.sum("n").alias("seen"), best.alias("best"))
    rules = rules.select("suffix", F.col("best.replacement").alias("replacement"), (-F.col("best.rank")).alias("agreeing"), "seen")
    return rules.where((F.col("agreeing") >= least) & (F.col("agreeing") * 100 >= F.col("seen") * percent))


def ruled_lemmas(words: DataFrame, lemmas: DataFrame, rules: DataFrame, longest: int = LONGEST, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(word, lemma) for the distinct ``words`` that the table does not hold and a rule changes."""
    held = lemmas.select(F.col("form").alias("word")).union(lemmas.select("lemma")).distinct()
    unknown = words.where(F.col("word").rlike(RULED)).join(held, "word", "left_anti")
    ends = unknown.select("word", F.explode(_endings(F.col("word"), longest)).alias("k"))
    ends = ends.withColumn("suffix", F.right("word", F.col("k")))
    found = lookup(ends, rules.select("suffix", "replacement"), "suffix", ["word"], limit).where("replacement IS NOT NULL")
    longest_rule = found.groupBy("word").agg(F.max_by(F.struct("suffix", "replacement"), "k").alias("rule"))
    stem = F.left("word", F.length("word") - F.length("rule.suffix"))
    lemma = F.concat(stem, F.col("rule.replacement"))
    return longest_rule.select("word", lemma.alias("lemma")).where("lemma <> word")


def lemmatize_with_rules(
    df: DataFrame, lemmas: DataFrame, key: str, source: str, target: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """As :func:`lemmatize_with_table`; words that the table does not hold follow the rules learned from it.

    Words with anything but letters a to z, in either case, are looked up in the table alone. Every row is
    kept; null texts become empty, null and repeated keys keep their rows.
    """
    rules = written(suffix_rules(lemmas), "suffix-rules")
    words = df.select(F.explode(split_words(F.lower(F.coalesce(F.col(source), F.lit(""))))).alias("word")).distinct()
    ruled = ruled_lemmas(words, lemmas, rules, limit=limit)
    table = _one_lemma(lemmas).unionByName(ruled.withColumnRenamed("word", "form"))
    table = written(table.withColumnRenamed("lemma", "replacement"), "lemma-table")
    return replace_words(df, table, key, source, target, F.lower, limit)
