"""The full cleaning chain over a text column.

Each stage is a projection of its own. A stage reads its input more than once (a check for a
trigger character, then the work), so one nested expression would repeat every earlier stage;
as projections they are computed once, in one pass over the rows and without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sipnote.functions import text as T
from sipnote.functions.word_tables import LEMMAS


@dataclass(frozen=True)
class CleanOptions:
    """Switches of the cleaning chain. A stage that is off is left out of the plan.

    Translation and spelling look things up in tables, which ``plans.process.clean_reviews``
    takes as arguments; here they only say whether a given table is used.
    """

    translate: bool = True
    html: bool = True
    contractions: bool = True
    emails_urls: bool = True
    repeated_chars: bool = True
    special_chars: bool = True
    lemmatize: bool = True
    spellcheck: bool = False
    spell_edits: int = 1
    lemmas: dict[str, str] = field(default_factory=lambda: LEMMAS, hash=False)


def clean_before_lemmas(df: DataFrame, source: str, target: str, options: CleanOptions) -> DataFrame:
    """Markup, contractions, addresses, repeats and specials, in this order. Null gives ''."""
    stages = [
        (options.html, T.strip_markup),
        (options.html, T.decode_entities),
        (options.contractions, T.expand_contractions),
        (options.emails_urls, T.strip_emails),
        (options.emails_urls, T.strip_urls),
        (options.repeated_chars, T.squeeze_repeats),
        (options.special_chars, T.strip_specials),
    ]
    df = df.withColumn(target, F.coalesce(F.col(source), F.lit("")))
    for wanted, stage in stages:
        if wanted:
            df = df.withColumn(target, stage(F.col(target)))
    return df


def collapse(text: Column, options: CleanOptions) -> Column:
    """One blank between words. Contractions leave blanks only, and later stages only delete."""
    return T.collapse_blanks(text) if options.contractions else T.collapse_whitespace(text)


def clean_after_specials(df: DataFrame, source: str, target: str, options: CleanOptions) -> DataFrame:
    """Lemmas, then one blank between words."""
    df = df.withColumn(target, collapse(F.col(source), options))
    if options.lemmatize:
        words = F.split(F.col(target), " ")
        df = df.withColumn(target, F.array_join(T.lemmas_of(words, options.lemmas), " "))
    return df


def with_clean_text(
    df: DataFrame, source: str = "text", target: str = "cleaned_text", options: CleanOptions = CleanOptions()
) -> DataFrame:
    """Add the cleaned text, by the stages that need no table."""
    return clean_after_specials(clean_before_lemmas(df, source, target, options), target, target, options)
