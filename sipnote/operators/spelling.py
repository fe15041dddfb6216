"""Spelling correction against a word-frequency table, by equi-joins on deletion keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sipnote.functions.text import split_words, word_core
from sipnote.operators.lookup import BROADCAST_BYTES, fits_broadcast
from sipnote.operators.words import replace_words
from sipnote.session import written

CORRECTABLE = "^[a-z]{4,}$"
# Vocabulary words beyond this length are found by segments and not by leaving out two letters.
LONG = 15
SEGMENTS = 5
# Keys of a vocabulary up to this many bytes are sent to every executor; a word has up to a hundred and more of them.
KEY_BYTES = 4 * 1024 * 1024


def word_frequencies(df: DataFrame, text: str, min_freq: int = 20) -> DataFrame:
    """Lower-case words of four letters or more that occur ``min_freq`` times: (word, freq)."""
    listed = _listed(df, F.lower(F.coalesce(F.col(text), F.lit("")))).groupBy("listed").agg(F.count("*").alias("n"))
    return _bare(listed, "n").groupBy("word").agg(F.sum("n").alias("freq")).where(F.col("freq") >= min_freq)


def distinct_words(df: DataFrame, text: str) -> DataFrame:
    """The correctable words of a text column, once each."""
    return _bare(_listed(df, F.coalesce(F.col(text), F.lit(""))).distinct()).distinct()


def _listed(df: DataFrame, text: Column) -> DataFrame:
    """Words between white space, as they stand, that may be correctable."""
    # explode would add a filter on the size of the array below, and compute the words twice.
    words = df.select(split_words(text).alias("words")).select(F.explode_outer("words").alias("listed"))
    return words.where(F.col("listed").rlike("[a-z]{4}"))


def _bare(listed: DataFrame, *keep: str) -> DataFrame:
    """The correctable words among those of ``listed``, without what stands at their ends.

    Ends are looked at once for each distinct word and not wherever it occurs.
    """
    return listed.select(word_core(F.col("listed")).alias("word"), *keep).where(F.col("word").rlike(CORRECTABLE))


def _deletion_keys(word: Column) -> Column:
    """The word and the word with each single letter left out."""
    without = F.transform(
        F.sequence(F.lit(1), F.length(word)),
        lambda i: F.concat(F.left(word, i - 1), F.substr(word, i + 1)),
    )
    return F.array_distinct(F.concat(F.array(word), without))


def _swaps(word: Column) -> Column:
    """The word with each two neighbours swapped; a single letter stays."""

    def swapped(i: Column) -> Column:
        return F.concat(F.left(word, i - 2), F.substr(word, i, F.lit(1)), F.substr(word, i - 1, F.lit(1)), F.substr(word, i + 1))

    return F.transform(F.sequence(F.lit(2), F.greatest(F.length(word), F.lit(2))), swapped)


def _within_one_edit(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1).between(0, 1) | F.array_contains(_swaps(a), b)


def _within_two_edits(a: Column, b: Column) -> Column:
    """Whether two edits in a row lead from ``a`` to ``b``.

    Without a swap that is the plain distance, in which a swap counts two at most: three are left for
    a swap and another edit, three or four for two swaps. A swap comes first, seen from the one word
    or from the other.
    """
    distance = F.levenshtein(a, b, 4)
    one_more = lambda s, other: F.levenshtein(s, other, 1).between(0, 1)
    swap_and_edit = F.exists(_swaps(a), lambda s: one_more(s, b)) | F.exists(_swaps(b), lambda s: one_more(s, a))
    return (
        distance.between(0, 2)
        | ((distance == 3) & swap_and_edit)
        | ((distance >= 3) & (F.length(a) == F.length(b)) & F.arrays_overlap(_swaps(a), _swaps(b)))
    )


def _segment_key(length: Column, number: int, word: Column, shift: int = 0) -> Column:
    """Segment ``number`` of a word of ``length`` letters, as it stands in ``word`` after a shift; null outside."""
    start, end = F.floor(length * number / SEGMENTS), F.floor(length * (number + 1) / SEGMENTS)
    inside = (start + shift >= 0) & (end + shift <= F.length(word))
    letters = F.substr(word, (start + shift + 1).cast("int"), (end - start).cast("int"))
    return F.when(inside, F.concat_ws(":", length, F.lit(number), letters))


def _candidate_keys(word: Column) -> Column:
    """Keys of a vocabulary word for two edits: two letters left out, or its segments if it is long."""
    segments = F.array(*[_segment_key(F.length(word), i, word) for i in range(SEGMENTS)])
    return F.when(F.length(word) > LONG, segments).otherwise(_two_deletion_keys(word))


def _two_deletion_keys(word: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(_deletion_keys(word), _deletion_keys)))


def _searched_keys(word: Column) -> Column:
    """Keys of all vocabulary words that may be two edits away.

    Two edits change four of five segments at most, as a swap may fall on the border of two. A
    segment that stays has moved by two letters at most, in a word longer or shorter by two at most.
    """
    shifts = range(-2, 3)

    def segments(length: Column) -> Column:
        keys = F.array(*[_segment_key(length, i, word, by) for i in range(SEGMENTS) for by in shifts])
        return F.when(length > LONG, keys).otherwise(F.array().cast("array<string>"))

    lengths = F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda by: F.length(word) + by)
    long_keys = F.array_distinct(F.array_compact(F.flatten(F.transform(lengths, segments))))
    none = F.array().cast("array<string>")
    return F.concat(
        F.when(F.length(word) <= LONG + 2, _two_deletion_keys(word)).otherwise(none),
        F.when(F.length(word) + 2 > LONG, long_keys).otherwise(none),
    )


def _nearest(words: DataFrame, vocabulary: DataFrame, edits: int, searched, candidates, near) -> DataFrame:
    """(word, correction): the most frequent candidate that shares a key and is near, ties by spelling."""
    longest = vocabulary.agg(F.max(F.length("word"))).scalar()
    unknown = words.join(vocabulary, "word", "left_anti").where(F.length("word") <= longest + edits)
    left = unknown.select("word", F.explode(searched(F.col("word"))).alias("deletion_key"))
    right = vocabulary.select(
        F.col("word").alias("correction"), "freq", F.explode(candidates(F.col("word"))).alias("deletion_key")
    )
    # Spark takes the keys to be as large as the vocabulary they are made of, and would send all of them through the driver.
    right = F.broadcast(right) if fits_broadcast(right, KEY_BYTES) else right.hint("merge")
    best = F.min(F.struct((-F.col("freq")).alias("rank"), "correction"))
    return (
        left.join(right, "deletion_key")
        # Pairs that share several keys are compared once.
        .select("word", "correction", "freq")
        .distinct()
        .where(near(F.col("word"), F.col("correction")))
        .groupBy("word")
        .agg(best.alias("best"))
        .select("word", F.col("best")["correction"].alias("correction"))
    )


def spell_corrections(words: DataFrame, vocabulary: DataFrame, edits: int = 1) -> DataFrame:
    """(word, correction) for the words that are not in the vocabulary but one edit away.

    An edit inserts, deletes or replaces a letter or swaps two neighbours. Two words one edit
    apart share a deletion key, so candidates come from an equi-join on keys. Words are
    distinct and of the letters a to z, so a key of length L has at most 26 (L + 1) + 1 words
    on either side: no key is hot. The most frequent candidate wins, ties by spelling.

    With ``edits`` 2, words without a candidate at one edit take the best one at two edits. Those
    share a key with up to two letters left out, of which at most some 26 x 26 (L + 2)(L + 1) / 2 words
    hold one; words of more than ``LONG`` letters, which have too many such keys, share one of
    five segments. The words and the first result are written, as they are read twice.
    """
    if edits not in (1, 2):
        raise ValueError("edits is 1 or 2")
    if edits == 2:
        words = written(words, "words")  # of all texts, and read for either search
    one = _nearest(words, vocabulary, 1, _deletion_keys, _deletion_keys, _within_one_edit)
    if edits == 1:
        return one
    one = written(one, "one-edit")
    rest = words.join(one, "word", "left_anti")
    return one.unionByName(_nearest(rest, vocabulary, 2, _searched_keys, _candidate_keys, _within_two_edits))


def correct_spelling(
    df: DataFrame,
    vocabulary: DataFrame,
    key: str,
    source: str,
    target: str,
    limit: int = BROADCAST_BYTES,
    edits: int = 1,
) -> DataFrame:
    """Add ``target``: ``source`` with unknown words corrected; the others stay.

    The corrections are written to the shared folder, as the look-up reads them more than once.
    """
    # Words are looked up as they stand between white space, so list those and not their cores.
    listed = _listed(df, F.coalesce(F.col(source), F.lit(""))).select(F.col("listed").alias("word"))
    words = listed.where(F.col("word").rlike(CORRECTABLE)).distinct()
    corrections = written(spell_corrections(words, vocabulary, edits), "corrections")
    table = corrections.select(F.col("word").alias("form"), F.col("correction").alias("replacement"))
    return replace_words(df, table, key, source, target, limit=limit)
