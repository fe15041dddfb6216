"""Sentiment labels from ratings, from model output and from keywords."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sipnote.functions.fixed_values import (
    COMPLAINT_WORDS,
    LABELS,
    MODEL_LABELS,
    NEGATIVE_UP_TO,
    POSITIVE_FROM,
    PRAISE_WORDS,
    SOFTENING_WORDS,
)
from sipnote.functions.text import literal_map


def label_sentiment(rating: Column) -> Column:
    """Positive, Negative or Neutral; a missing rating (null or NaN) is Neutral."""
    # NaN sorts above every number in Spark, so it has to be ruled out first.
    return (
        F.when(rating.isNull() | F.isnan(rating), "Neutral")
        .when(rating >= POSITIVE_FROM, "Positive")
        .when(rating <= NEGATIVE_UP_TO, "Negative")
        .otherwise("Neutral")
    )


def label_code(label: Column) -> Column:
    """0, 1 or 2; null for an unknown label."""
    codes = F.create_map(*[x for i, name in enumerate(LABELS) for x in (F.lit(name), F.lit(i))])
    return F.try_element_at(codes, label)


def label_name(code: Column) -> Column:
    """The label of a code; null for an unknown code."""
    return F.get(F.array(*[F.lit(name) for name in LABELS]), code)


def normalize_label(label: Column) -> Column:
    """Label names of other models as ours; an unknown name stays as it is."""
    return F.coalesce(F.try_element_at(literal_map(MODEL_LABELS), label), label)


def capitalize_label(label: Column) -> Column:
    """First letter upper, the rest lower, for models that only differ in case."""
    return F.concat(F.upper(F.left(label, F.lit(1))), F.lower(F.substr(label, F.lit(2))))


def _contains_any(text: Column, words: list[str]) -> Column:
    return reduce(or_, [text.contains(w) for w in words])


def keyword_sentiment(text: Column) -> Column:
    """Rule baseline: complaints first, softened by good points, then praise. Case-sensitive."""
    text = F.coalesce(text, F.lit(""))
    softened = F.when(_contains_any(text, SOFTENING_WORDS), "Neutral").otherwise("Negative")
    return (
        F.when(_contains_any(text, COMPLAINT_WORDS), softened)
        .when(_contains_any(text, PRAISE_WORDS), "Positive")
        .otherwise("Neutral")
    )
