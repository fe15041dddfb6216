"""Language detection by character ranges."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sipnote.functions import patterns as P


def needs_translation(text: Column) -> Column:
    """True where the text holds a Japanese or full-width character; false for null."""
    return F.coalesce(F.rlike(text, F.lit(P.JAPANESE)), F.lit(False))


def language_flag(text: Column) -> Column:
    """``ja`` or ``en``."""
    return F.when(needs_translation(text), "ja").otherwise("en")
