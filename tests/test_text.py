import random
import re

import pytest
from pyspark.sql import functions as F

from sipnote.functions import text as T
from sipnote.functions.cleaning import CleanOptions, with_clean_text
from sipnote.functions.word_tables import LEMMAS, STOP_WORDS
from sipnote.operators.features import feature_tokens

NO_LEMMAS = CleanOptions(lemmatize=False)


def clean(texts, options, *values):
    rows = with_clean_text(texts(*values), options=options).collect()
    return [r.cleaned_text for r in sorted(rows, key=lambda r: r.review_id)]


def markup_by_states(text):
    """Plain restatement: one state at a time, found by plain searches."""
    out, at = [], 0
    while at < len(text):
        rest = text[at:].lower()
        for start, end in (("<script>", "</script>"), ("<style>", "</style>"), ("<!--", "-->")):
            if rest.startswith(start):
                close = rest.find(end, len(start))
                at = len(text) if close < 0 else at + close + len(end)
                break
        else:
            if rest.startswith(("<b>", "</b>", "</script>", "</style>")):
                at += rest.index(">") + 1
            else:
                out.append(text[at])
                at += 1
    return "".join(out)


def test_unclosed_elements_end_with_the_text(apply):
    rnd = random.Random(13)
    pieces = ["<script>", "</script>", "<STYLE>", "</style>", "<!--", "-->", "<b>", "</b>", "x", " y\n", "&"]
    values = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    assert apply(T.strip_markup, *values) == [markup_by_states(v) for v in values]
    assert apply(T.strip_html, "a<script src='q'>b", "c<!-- d <p>e</p>", "f<style", None, "") == ["a", "c", "f<style", None, ""]
    # Many that are never closed are one; the time does not grow with their square.
    assert apply(T.strip_markup, "g" + "<script>h" * 200_000, "i" + "<!-- j " * 200_000) == ["g", "i"]


def test_strip_html(apply):
    assert apply(
        T.strip_html,
        "<ul><li>Malt <i>first</i>;</li></ul> hops later",
        "<p>a</p><p>b</p>",
        "x<script>var t='</p>';</script><STYLE>p{}</STYLE><!-- no\nno -->y",
        "&amp;lt; &lt;b&gt; &eacute;&copy;",
        "&#65;&#x41;&#x1F600;",
        "&bogus; &copy &#0; &#xD800; a & b",
        "an <unclosed tag",
        "I <3 this, better -> best; price < 5 and rating > 3, a < b > c",
        '<a title="x>y" href=\'p>q\'>in</a><br/><!DOCTYPE html><b q">out</b> it\'s',
        "don&apos;t &#0039;quote&#x00027; &#00065 &amp b&ampc &notin; &hellip;&Oslash",
        "",
        None,
    ) == [
        "Malt first; hops later",
        "ab",
        "xy",
        "&lt; <b> é©",
        "AA😀",
        "&bogus; © &#0; &#xD800; a & b",
        "an <unclosed tag",
        "I <3 this, better -> best; price < 5 and rating > 3, a < b > c",
        "inout it's",
        "don't 'quote' A & b&c ∉ …Ø",
        "",
        None,
    ]


def test_expand_contractions(apply):
    assert apply(
        T.expand_contractions,
        "We couldn't taste hops; wasn't that odd?",
        "can't, CAN'T Don't \"Don't I'm I'M",
        "'cause don’t y'all'd've",
        "  no \t apostrophe here\n",
        "it's",
        "'' ' o'clock!",
        "",
        None,
    ) == [
        "We could not taste hops; was not that odd?",
        "cannot CANNOT Do not do not I am I AM",
        "'cause don’t you all would have",
        "no apostrophe here",
        "it is",
        "'' ' of the clock",
        "",
        None,
    ]


def test_strip_emails_urls(apply):
    out = apply(
        T.strip_emails_urls,
        "Opening times: https://taproom.example.com/open (or ask bar@taproom.example)",
        "a@b no.address@ www.x.org/a?b=1, http://y.z　end",
        "-x.y@z.com|",
    )
    assert out == ["Opening times:  (or ask )", "a@b no.address@  　end", "-|"]


def test_squeeze_repeats(apply):
    assert apply(
        T.squeeze_repeats, "A loooong, sloooow pouuuur!", "a\n\n\n\nb", "...  ----", "😀😀😀😀x", "aa"
    ) == ["A loong, sloow pouur!", "a\n\n\n\nb", "..  --", "😀😀x", "aa"]


def test_strip_specials(apply):
    text = "Two-row; pale (malt) @ 5%!"
    assert apply(T.strip_specials, text, "á ² ½ 😀 𝒳_y “q” a b") == [
        "Tworow pale malt  5",
        "a ² ½  𝒳_y q a b",
    ]


MIXED = "a b　c\xa0d\x1ce  f\n\ng …“Héllo”— ½ ² é 😀 𝒳 x_y ’s ‘q’ it’s -a-b- 東京。日本 \x85z\x0b"


def test_unicode_classes_follow_python(apply):
    assert apply(T.collapse_whitespace, MIXED) == [re.sub(r"\s+", " ", MIXED).strip()]
    assert apply(T.strip_specials, MIXED) == [re.sub(r"[^\w\s]", "", MIXED)]
    assert apply(T.normalize_light, "  A\tB\n\nC  ") == ["a b c"]
    assert apply(feature_tokens, MIXED + " Ab c") == [re.findall(r"(?u)\b\w\w+\b", (MIXED + " Ab c").lower())]


def test_whole_unicode_range_of_the_basic_plane(apply):
    """Every character on its own: white space exactly as in Python, letters but for newer ones."""
    chars = [chr(c) for c in range(1, 0xFFFF) if not 0xD800 <= c <= 0xDFFF]
    spaced = apply(lambda c: T.collapse_whitespace(F.concat(F.lit("x"), c, F.lit("x"))), *chars)
    assert [c for c, s in zip(chars, spaced) if (s == "x x") != c.isspace()] == []
    kept = apply(T.strip_specials, *chars)
    word_or_space = re.compile(r"[\w\s]")
    wrong = [c for c, k in zip(chars, kept) if bool(k) != bool(word_or_space.match(c))]
    assert all(c.isalpha() for c in wrong) and len(wrong) < 250


def test_tokens_strip_outer_marks(apply):
    assert apply(T.tokens, "(six-pack), \"it's\" -- _x_ “Zwölf”… ¡olé!", "...a-b... !! (x)", "", "--") == [
        ["six-pack", "it's", "_x_", "Zwölf", "olé"],
        ["a-b", "x"],
        [],
        [],
    ]


def test_lemmas_and_content_tokens(apply):
    assert apply(lambda c: T.lemmatize_words(c, LEMMAS), "The Hops  were great beers") == ["The hop be great beer"]
    assert apply(
        lambda c: T.content_tokens(c, LEMMAS, STOP_WORDS), "This  IPA has 2 HOPS, and it's very good!"
    ) == ["ipa hop good"]


def test_full_chain(texts):
    raw = "<p>I didn't like the cheap pricing... at us@example.com</p>"
    assert clean(texts, NO_LEMMAS, raw, None, "", " \n ") == ["I did not like the cheap pricing at", "", "", ""]


@pytest.mark.parametrize(
    "off, expected",
    [
        ("html", "pI did not like beerssp"),
        ("contractions", "I didnt like beerss"),
        ("repeated_chars", "I did not like beersss"),
        ("special_chars", "I did not like beerss"),
        ("emails_urls", "I did not like beerss"),
    ],
)
def test_switches_leave_stages_out(texts, off, expected):
    options = CleanOptions(lemmatize=False, **{off: False})
    raw = "<p>I didn't like beersss</p>"
    assert clean(texts, options, raw) == [expected]
