"""Cleaning steps as column functions: text column in, text column out, null in, null out.

Each step with a rare trigger character first checks for it with ``contains``. The check is
exact (the pattern cannot match without that character) and spares most rows the regex.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from sipnote.functions import patterns as P
from sipnote.functions.fixed_values import CONTRACTION_TRIM, CONTRACTIONS


def literal_map(pairs: dict[str, str]) -> Column:
    """A constant string map; folded to one literal by the optimizer."""
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _is_ascii(text: Column) -> Column:
    """One byte per character; far cheaper to find out than a pass of a regex."""
    return F.octet_length(text) == F.length(text)


def _unless_ascii(text: Column, changed: Column) -> Column:
    return F.when(_is_ascii(text), text).otherwise(changed)


def collapse_whitespace(text: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    latin = F.regexp_replace(text, P.LATIN_SPACE_RUN, " ")
    blanks = _unless_ascii(latin, F.regexp_replace(latin, P.WIDE_SPACE, " "))
    return F.btrim(F.regexp_replace(blanks, P.BLANK_RUN, " "))


def collapse_blanks(text: Column) -> Column:
    """The same for a text whose only white space is the blank."""
    single = F.when(text.contains("  "), F.regexp_replace(text, P.BLANK_RUN, " ")).otherwise(text)
    return F.btrim(single)


def split_words(text: Column) -> Column:
    """White-space separated words; an empty text gives one empty word.

    Splitting on a plain blank needs no regex engine, so white space is collapsed first.
    """
    return F.split(collapse_whitespace(text), " ")


def _code_point(piece: Column) -> Column:
    """Code point of ``&#65;`` or ``&#x41;`` at the start of ``piece``; null without one."""
    decimal = F.regexp_extract(piece, P.DECIMAL_ENTITY, 1)
    hexadecimal = F.regexp_extract(piece, P.HEX_ENTITY, 1)
    number = F.when(decimal != "", F.conv(decimal, 10, 10)).when(hexadecimal != "", F.conv(hexadecimal, 16, 10))
    return number.cast("long")


def _decode_entity(piece: Column) -> Column:
    """Decode the reference at the start of ``piece``; leave unknown ones as they are.

    A numbered reference may lack its semicolon, and so may the old names, of which the longest
    that fits counts.
    """
    name = F.regexp_extract(piece, P.NAMED_ENTITY, 1)
    named = F.try_element_at(literal_map({n: chr(c) for n, c in name2codepoint.items()} | {"apos": "'"}), name)
    bare_name = F.regexp_extract(piece, P.BARE_ENTITY, 1)
    bare = F.try_element_at(literal_map({n: html5[n] for n in P.BARE_NAMES}), bare_name)
    code = _code_point(piece)
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    after = lambda length: F.substring(piece, length + 1, F.length(piece))
    return (
        F.when(valid, F.concat(F.decode(utf32, "UTF-32"), after(F.length(F.regexp_extract(piece, P.NUMBERED_ENTITY, 0)))))
        .when(named.isNotNull(), F.concat(named, after(F.length(name) + 2)))
        .when(bare.isNotNull(), F.concat(bare, after(F.length(bare_name) + 1)))
        .otherwise(piece)
    )


def decode_entities(text: Column) -> Column:
    """Decode named and numeric character references in one pass, so ``&amp;lt;`` gives ``&lt;``."""
    pieces = F.split(text, "(?=&)")
    decoded = F.array_join(F.transform(pieces, _decode_entity), "")
    return F.when(text.contains("&"), decoded).otherwise(text)


def strip_markup(text: Column) -> Column:
    """Remove script and style with their content, comments and tags.

    One pass from left to right: what stands in a script is no comment, and the other way round. One
    that is never closed ends with the text.
    """
    return F.when(text.contains("<"), F.regexp_replace(text, P.HTML_MARKUP, "")).otherwise(text)


def strip_html(text: Column) -> Column:
    """Markup to plain text: remove markup, then decode character references."""
    return decode_entities(strip_markup(text))


def _expand_word(word: Column) -> Column:
    expansion = F.try_element_at(
        literal_map(CONTRACTIONS), F.btrim(F.lower(word), F.lit(CONTRACTION_TRIM))
    )
    first = F.left(word, F.lit(1))
    all_upper = (F.upper(word) == word) & (F.lower(word) != word)
    first_upper = (F.upper(first) == first) & (F.lower(first) != first)
    capitalised = F.concat(F.upper(F.left(expansion, F.lit(1))), F.lower(F.substr(expansion, F.lit(2))))
    return (
        F.when(~word.contains("'") | expansion.isNull(), word)
        .when(all_upper, F.upper(expansion))
        .when(first_upper, capitalised)
        .otherwise(expansion)
    )


def expand_contractions(text: Column) -> Column:
    """Replace contracted words by their long form and collapse white space.

    A hit replaces the whole word with its outer punctuation, and follows the word's case.
    Every key that can be hit holds an apostrophe, so the text is cut before such words only:
    the loop runs over those pieces and not over all words.
    """

    def expand_first(piece: Column) -> Column:
        word = F.substring_index(piece, " ", 1)
        return F.concat(_expand_word(word), F.substr(piece, F.length(word) + 1))

    pieces = F.split(collapse_whitespace(text), P.BLANK_BEFORE_APOSTROPHE_WORD)
    expanded = F.array_join(F.transform(pieces, expand_first), " ")
    return F.when(text.contains("'"), expanded).otherwise(collapse_whitespace(text))


def strip_emails(text: Column) -> Column:
    return F.when(text.contains("@"), F.regexp_replace(text, P.EMAIL, "")).otherwise(text)


def strip_urls(text: Column) -> Column:
    has_url = text.contains("://") | text.contains("www.")
    return F.when(has_url, F.regexp_replace(text, P.URL, "")).otherwise(text)


def strip_emails_urls(text: Column) -> Column:
    """Delete e-mail addresses, then web addresses."""
    return strip_urls(strip_emails(text))


def squeeze_repeats(text: Column) -> Column:
    """Runs of two or more equal characters become exactly two; newlines stay.

    The pattern starts at three, since a pair is what a longer run becomes.
    """
    return F.regexp_replace(text, P.REPEATED_CHAR, "$1$1")


def strip_specials(text: Column) -> Column:
    """Delete everything but letters, digits, underscore and white space."""
    bare = F.regexp_replace(text, P.ASCII_SPECIAL_RUN, "")
    return _unless_ascii(bare, F.regexp_replace(bare, P.OTHER_SPECIAL, ""))


def normalize_light(text: Column) -> Column:
    """Collapse white space and lower-case."""
    return F.lower(collapse_whitespace(text))


def lemmas_of(words: Column, lemmas: dict[str, str]) -> Column:
    """Each word, or its lemma where the table has one.

    Membership is tested with a hash set, the map is read only for words that are in it.
    For a table too large for a literal use ``operators.lemmatize.lemmatize_with_table``.
    """
    table, forms = literal_map(lemmas), list(lemmas)

    def lemma(word: Column) -> Column:
        key = F.lower(word)
        return F.when(key.isin(forms), F.try_element_at(table, key)).otherwise(word)

    return F.transform(words, lemma)


def lemmatize_words(text: Column, lemmas: dict[str, str]) -> Column:
    """Replace each word by its lemma; unknown words stay as they are."""
    return F.array_join(lemmas_of(split_words(text), lemmas), " ")


def content_tokens(text: Column, lemmas: dict[str, str], stop_words: list[str]) -> Column:
    """Lemmas of the purely alphabetic words that are not stop words, joined by blanks."""
    words = F.filter(
        tokens(normalize_light(text)), lambda w: w.rlike(P.LETTERS_ONLY) & ~w.isin(stop_words)
    )
    return F.array_join(lemmas_of(words, lemmas), " ")


def word_core(word: Column) -> Column:
    """A word without non-word characters at its ends."""
    ascii_bare = F.regexp_replace(word, P.ASCII_EDGES, "")
    return F.when(_is_ascii(word), ascii_bare).otherwise(F.regexp_replace(word, P.ANY_EDGES, ""))


def tokens(text: Column) -> Column:
    """Words without non-word characters at their ends; empty ones are dropped.

    An ASCII text is trimmed as a whole; only in others every word is looked at.
    """
    collapsed = collapse_whitespace(text)
    before = F.regexp_replace(F.concat(F.lit(" "), collapsed), P.ASCII_BEFORE_WORD, " ")
    whole = F.split(F.regexp_replace(before, P.ASCII_BEHIND_WORD, ""), " ")
    each = F.transform(F.split(collapsed, " "), word_core)
    return F.filter(F.when(_is_ascii(text), whole).otherwise(each), lambda w: w != "")
