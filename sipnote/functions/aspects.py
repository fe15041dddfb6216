"""Aspect lexicon matching as column functions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from sipnote.functions.fixed_values import ASPECT_TERMS
from sipnote.functions.text import literal_map, tokens
from sipnote.functions.word_tables import LEMMAS


@dataclass(frozen=True)
class AspectLexicon:
    """Terms per category. Terms with a blank or hyphen are phrases, the others are words."""

    terms: dict[str, list[str]] = field(default_factory=lambda: ASPECT_TERMS, hash=False)
    lemmas: dict[str, str] = field(default_factory=lambda: LEMMAS, hash=False)

    @property
    def categories(self) -> list[str]:
        return list(self.terms)

    @property
    def words(self) -> dict[str, str]:
        """Word -> category; the last category wins where a word is listed twice."""
        return {t.lower(): c for c, ts in self.terms.items() for t in ts if not _is_phrase(t)}

    @property
    def phrases(self) -> list[tuple[str, str]]:
        return [(c, t.lower()) for c, ts in self.terms.items() for t in ts if _is_phrase(t)]

    @property
    def forms(self) -> dict[str, str]:
        """Every surface form that leads to a lexicon word -> that word."""
        words = self.words
        inflected = {form: lemma for form, lemma in self.lemmas.items() if lemma in words}
        kept = {w: w for w in words if w not in self.lemmas}
        return {**kept, **inflected}


def _is_phrase(term: str) -> bool:
    return " " in term or "-" in term


def word_hits(words: Column, lexicon: AspectLexicon) -> Column:
    """Lexicon words in order: array of (category, text, lemma, index of the token).

    One hash-set test per token; the maps are read for hits only.
    """
    forms = lexicon.forms
    to_word = literal_map(forms)
    to_category = literal_map({form: lexicon.words[word] for form, word in forms.items()})

    def hit(word: Column, index: Column) -> Column:
        form = F.lower(word)
        found = F.struct(
            F.try_element_at(to_category, form).alias("category"),
            word.alias("text"),
            F.try_element_at(to_word, form).alias("lemma"),
            index.alias("index"),
        )
        return F.when(form.isin(list(forms)), found)

    return F.array_compact(F.transform(words, hit))


def phrase_hits(text: Column, lexicon: AspectLexicon) -> Column:
    """Phrases found anywhere in the lower-cased text, once each, with index -1."""
    lowered = F.lower(text)
    found = [
        F.when(
            lowered.contains(term),
            F.struct(
                F.lit(category).alias("category"),
                F.lit(term).alias("text"),
                F.lit(term).alias("lemma"),
                F.lit(-1).alias("index"),
            ),
        )
        for category, term in lexicon.phrases
    ]
    return F.array_compact(F.array(*found))


def aspect_hits(text: Column, lexicon: AspectLexicon) -> Column:
    """Word hits in text order, then phrase hits."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(word_hits(tokens(text), lexicon), phrase_hits(text, lexicon))


def hit_categories(text: Column, lowered_words: Column, lexicon: AspectLexicon) -> Column:
    """The category of every hit; all that counting needs."""
    forms = lexicon.forms
    to_category = literal_map({form: lexicon.words[word] for form, word in forms.items()})
    hits = F.filter(lowered_words, lambda t: t.isin(list(forms)))
    in_words = F.transform(hits, lambda t: F.try_element_at(to_category, t))
    in_text = [F.when(F.lower(text).contains(term), F.lit(category)) for category, term in lexicon.phrases]
    return F.concat(in_words, F.array_compact(F.array(*in_text)))


def count_category(categories: Column, category: str) -> Column:
    return F.size(F.filter(categories, lambda c: c == category))


def nested_aspects(hits: Column, lexicon: AspectLexicon) -> Column:
    """Map of category -> (count, matches), every category present."""

    def entry(category: str) -> Column:
        matches = F.transform(
            F.filter(hits, lambda h: h["category"] == category),
            lambda h: F.struct(h["text"].alias("text"), h["lemma"].alias("lemma"), h["index"].alias("index")),
        )
        return F.struct(F.size(matches).alias("count"), matches.alias("matches"))

    return F.create_map(*[x for c in lexicon.categories for x in (F.lit(c), entry(c))])
