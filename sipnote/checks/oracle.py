"""The same queries as SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

from sipnote.checks import fixture_sql
from sipnote.functions.fixed_values import (
    ASPECT_TERMS,
    CONTRACTIONS,
    DOMAIN_KEYWORDS,
    FALLBACK_JAPANESE,
    LABELS,
    MODEL_LABELS,
)
from sipnote.functions.word_tables import LEMMAS, STOP_WORDS

SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_SPACE = "[^" + SPACE[1:]
NOT_WORD = r"[^\p{L}\p{N}_]"
JAPANESE = r"[\x{3000}-\x{303f}\x{3040}-\x{309f}\x{30a0}-\x{30ff}\x{ff00}-\x{ffef}\x{4e00}-\x{9faf}]"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def sql_map(pairs: dict[str, str]) -> str:
    return f"MAP({sql_list(pairs)}, {sql_list(pairs.values())})"


def collapse(e: str) -> str:
    return f"trim(regexp_replace({e}, '{SPACE}+', ' ', 'g'))"


def words(e: str) -> str:
    return f"list_filter(string_split_regex({e}, '{SPACE}+'), lambda w: w <> '')"


def tokens(e: str) -> str:
    bare = f"regexp_replace(regexp_replace(w, '^{NOT_WORD}+', ''), '{NOT_WORD}+$', '')"
    return f"list_filter(list_transform({words(e)}, lambda w: {bare}), lambda w: w <> '')"


def strip_html(e: str) -> str:
    tag = """</?[A-Za-z]([^>"'']|"[^"]*"|''[^'']*'')*>|<![A-Za-z][^>]*>"""
    bare = (
        rf"regexp_replace({e}, '(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->|{tag}', '', 'g')"
    )
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("apos", "''"), ("#0039", "''"), ("amp", "&")):
        bare = f"replace({bare}, '&{name};', '{char}')"
    return bare


def expand_contractions(e: str) -> str:
    entry = f"{sql_map(CONTRACTIONS)}[trim(lower(w), '.,?!:;\"''')]"
    cased = f"""CASE WHEN {entry} IS NULL THEN w
        WHEN upper(w) = w AND lower(w) <> w THEN upper({entry})
        WHEN upper(w[1]) = w[1] AND lower(w[1]) <> w[1] THEN upper({entry}[1]) || lower({entry}[2:])
        ELSE {entry} END"""
    return f"array_to_string(list_transform({words(e)}, lambda w: {cased}), ' ')"


def strip_emails_urls(e: str) -> str:
    no_mail = rf"regexp_replace({e}, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}\b', '', 'g')"
    return rf"regexp_replace({no_mail}, 'https?://{NOT_SPACE}+|www\.{NOT_SPACE}+', '', 'g')"


def squeeze(chars: str) -> str:
    """``chars`` is the text as a list of characters."""
    keep = f"not (i > 2 AND c <> chr(10) AND c = {chars}[i-1] AND c = {chars}[i-2])"
    return f"array_to_string(list_filter({chars}, lambda c, i: {keep}), '')"


def strip_specials(e: str) -> str:
    return rf"regexp_replace({e}, '[^\p{{L}}\p{{N}}_{SPACE[1:-1]}]', '', 'g')"


def lemmas_of(word_list: str) -> str:
    entry = f"coalesce({sql_map(LEMMAS)}[lower(w)], w)"
    return f"array_to_string(list_transform({word_list}, lambda w: {entry}), ' ')"


VIEWS = "reviews AS (" + fixture_sql.REVIEWS.format(documents="documents", part="part") + ")"
PREDICTIONS = (
    VIEWS + ", predictions AS (" + fixture_sql.PREDICTIONS.format(reviews="reviews", labels="labels") + ")"
)
MEMORY = VIEWS + ", memory AS (" + fixture_sql.TRANSLATION_MEMORY.format(reviews="reviews") + ")"


def over_reviews(body: str, extra: str = "") -> str:
    return f"WITH {VIEWS}{extra} {body}"


def text_query(expression: str) -> str:
    return over_reviews(f"SELECT review_id, {expression} AS text FROM reviews")


def cleaned(source: str) -> str:
    """CTEs from ``source`` (review_id, text) to cleaned (review_id, plain, cleaned_text)."""
    return f""",
    c1 AS (SELECT review_id, {strip_html("coalesce(text, '')")} AS t FROM {source}),
    c2 AS (SELECT review_id, {expand_contractions('t')} AS t FROM c1),
    c3 AS (SELECT review_id, string_split({strip_emails_urls('t')}, '') AS t FROM c2),
    c4 AS (SELECT review_id, {squeeze('t')} AS t FROM c3),
    c5 AS (SELECT review_id, {strip_specials('t')} AS plain FROM c4),
    cleaned AS (SELECT review_id, plain, {lemmas_of(words('plain'))} AS cleaned_text FROM c5)"""


TRANSLATED = f""",
    translated AS (
      SELECT r.* EXCLUDE (text),
             CASE WHEN regexp_matches(r.text, '{JAPANESE}') THEN coalesce(nullif(m.translated, ''), r.text)
                  ELSE r.text END AS text
      FROM reviews r LEFT JOIN memory m ON m.source_text = r.text)"""

WORD_ROWS = [(t, c) for c, ts in ASPECT_TERMS.items() for t in ts if " " not in t and "-" not in t]
PHRASE_ROWS = [(t, c) for c, ts in ASPECT_TERMS.items() for t in ts if " " in t or "-" in t]


def values(rows) -> str:
    return ", ".join("(" + ", ".join(lit(x) for x in row) + ")" for row in rows)


SUFFIX_LEMMAS = f""",
    known(form, lemma) AS (VALUES {values(list(LEMMAS.items()))}),
    pairs AS (SELECT form, lemma FROM known
              UNION ALL SELECT DISTINCT lemma, lemma FROM known WHERE lemma NOT IN (SELECT form FROM known)),
    cut AS (SELECT form, lemma, length(form) - k AS stem, form[length(form) - k + 1:] AS suffix
            FROM pairs, range(1, 6) AS ks(k) WHERE regexp_matches(form, '^[a-z]+$') AND length(form) >= k + 2),
    tallied AS (SELECT suffix, CASE WHEN lemma[:stem] = form[:stem] THEN lemma[stem + 1:] END AS replacement, count(*) AS n
                FROM cut GROUP BY ALL),
    rules AS (SELECT suffix, replacement FROM (
                SELECT *, sum(n) OVER (PARTITION BY suffix) AS seen,
                  row_number() OVER (PARTITION BY suffix ORDER BY replacement IS NULL, n DESC, replacement) AS place FROM tallied)
              WHERE place = 1 AND replacement IS NOT NULL AND n >= 2 AND n * 100 >= seen * 60),
    heard_words AS (SELECT DISTINCT unnest({words("lower(coalesce(text, ''))")}) AS word FROM reviews),
    unknown AS (SELECT word FROM heard_words WHERE regexp_matches(word, '^[a-z]{{3,}}$')
                AND word NOT IN (SELECT form FROM known UNION SELECT lemma FROM known)),
    matched AS (SELECT word, suffix, replacement, row_number() OVER (PARTITION BY word ORDER BY length(suffix) DESC) AS place
                FROM unknown JOIN rules ON length(word) >= length(suffix) + 2 AND right(word, length(suffix)) = suffix),
    ruled AS (SELECT word, lemma FROM (
                SELECT word, word[:length(word) - length(suffix)] || replacement AS lemma FROM matched WHERE place = 1)
              WHERE lemma <> word)"""


def matches(source: str, text: str) -> str:
    """CTEs ending in token_hits and phrase_hits over ``source``."""
    return f""",
    lexicon(term, category) AS (VALUES {values(WORD_ROWS)}),
    phrases(term, category) AS (VALUES {values(PHRASE_ROWS)}),
    token_lists AS (SELECT review_id, {tokens(f"coalesce({text}, '')")} AS ts FROM {source}),
    token_rows AS (
      SELECT review_id, unnest(ts) AS match_text, CAST(unnest(range(len(ts))) AS INTEGER) AS token_index FROM token_lists),
    token_lemmas AS (
      SELECT *, coalesce({sql_map(LEMMAS)}[lower(match_text)], lower(match_text)) AS lemma FROM token_rows),
    token_hits AS (
      SELECT review_id, category, match_text, lemma, token_index FROM token_lemmas JOIN lexicon ON lemma = term),
    phrase_hits AS (
      SELECT review_id, category, term AS match_text, term AS lemma, CAST(-1 AS INTEGER) AS token_index
      FROM {source}, phrases WHERE contains(lower(coalesce({text}, '')), term)),
    hits AS (SELECT *, token_index = -1 AS late FROM token_hits UNION ALL SELECT *, true FROM phrase_hits)"""


CATEGORIES = list(ASPECT_TERMS)
COUNTS = ", ".join(
    f"CAST(count(*) FILTER (WHERE category = '{c}') AS INTEGER) AS aspect_{c}" for c in CATEGORIES
)
PROCESSED = (
    cleaned("reviews")
    + matches("cleaned", "plain")
    + f""",
    counted AS (SELECT review_id, {COUNTS} FROM hits GROUP BY review_id),
    processed AS (
      SELECT r.review_id, r.beer_name, r.style, r.rating_overall, r.text, c.cleaned_text,
             {", ".join(f"coalesce(n.aspect_{c}, 0) AS aspect_{c}" for c in CATEGORIES)}
      FROM reviews r JOIN cleaned c USING (review_id) LEFT JOIN counted n USING (review_id))"""
)

LABELLED = """, labelled AS (
    SELECT *, CASE WHEN rating_overall IS NULL OR isnan(rating_overall) THEN 'Neutral'
                   WHEN rating_overall >= 4.0 THEN 'Positive'
                   WHEN rating_overall <= 2.5 THEN 'Negative' ELSE 'Neutral' END AS sentiment FROM reviews)"""

RANKED = (
    LABELLED
    + """,
    ranked AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY md5(concat('42:', review_id)), review_id) AS rank
               FROM labelled),
    sizes AS (SELECT sentiment, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM labelled GROUP BY sentiment),
    shares AS (SELECT *, ((total + 4) // 5) * n // total AS base, ((total + 4) // 5) * n % total AS remainder,
                      (total + 4) // 5 AS wanted FROM sizes),
    quotas AS (SELECT sentiment, base + CASE WHEN row_number() OVER (ORDER BY remainder DESC, sentiment)
                                                  <= wanted - CAST(sum(base) OVER () AS BIGINT) THEN 1 ELSE 0 END AS quota
               FROM shares),
    split AS (SELECT r.*, CASE WHEN rank <= quota THEN 'test' ELSE 'train' END AS split
              FROM ranked r JOIN quotas USING (sentiment))"""
)

GRAMS = r""",
    token_table AS (SELECT review_id, split, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}') AS ts FROM split),
    gram_lists AS (SELECT review_id, split, list_concat(ts, list_transform(range(1, len(ts)), lambda i: ts[i] || ' ' || ts[i+1])) AS gs
                   FROM token_table),
    grams AS (SELECT review_id, split, unnest(gs) AS term FROM gram_lists),
    counts AS (SELECT review_id, split, term, count(*) AS tf FROM grams GROUP BY ALL),
    vocabulary AS (
      SELECT term, CAST(sum(tf) AS BIGINT) AS term_count, count(*) AS doc_freq,
             ln((1.0 + (SELECT count(*) FROM split WHERE split = 'train')) / (1.0 + count(*))) + 1.0 AS idf
      FROM counts WHERE split = 'train' GROUP BY term ORDER BY term_count DESC, term LIMIT 10000)"""


def normalized(column: str) -> str:
    return f"coalesce({sql_map(MODEL_LABELS)}[{column}], {column})"


PREDICTED = (
    PREDICTIONS
    + f""", predicted AS (SELECT review_id, text, true_label, {normalized('raw_pred_a')} AS pred_a,
                                 {normalized('raw_pred_b')} AS pred_b FROM predictions)"""
)
LABEL_VALUES = ", ".join(f"({lit(x)}, {i})" for i, x in enumerate(LABELS))


def scores(pred: str, name: str) -> str:
    return f""", {name} AS (
      SELECT label, tp, support, predicted,
             CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS "precision",
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
             CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f1
      FROM (SELECT label, count(*) FILTER (WHERE true_label = label AND {pred} = label) AS tp,
                   count(*) FILTER (WHERE true_label = label) AS support,
                   count(*) FILTER (WHERE {pred} = label) AS predicted
            FROM (VALUES {LABEL_VALUES}) AS l(label, code), predicted GROUP BY label))"""


def keyword_rule(text: str) -> str:
    has = lambda *ws: "(" + " OR ".join(f"contains({text}, '{w}')" for w in ws) + ")"
    return f"""CASE WHEN {has('flat', 'damage', 'disappoint')}
                    THEN CASE WHEN {has('lacing', 'good')} THEN 'Neutral' ELSE 'Negative' END
                    WHEN {has('good', 'gorgeous', 'delicious')} THEN 'Positive' ELSE 'Neutral' END"""


KEYWORDS = ", ".join(f"({lit(k)})" for k in DOMAIN_KEYWORDS)
OVERLAY = "CASE WHEN rating_overall >= 4.0 THEN 'これは美味しいビールです。' ELSE " + lit(FALLBACK_JAPANESE) + " END"


def mixed(order: str, n: int) -> str:
    return over_reviews(
        f"""SELECT review_id, CASE WHEN rank <= {n} THEN {OVERLAY} ELSE text END AS text,
                   CASE WHEN rank <= {n} THEN 'ja' ELSE 'en' END AS language
            FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM reviews)"""
    )


# Words of both sides meet on the word with one letter left out; then the distance decides.
CORRECTIONS = rf""",
    vocabulary AS (
      SELECT word, count(*) AS freq
      FROM (SELECT unnest({tokens("lower(coalesce(text, ''))")}) AS word FROM documents)
      WHERE regexp_matches(word, '^[a-z]{{4,}}$') GROUP BY word HAVING count(*) >= 20),
    unknown AS (
      SELECT word FROM heard WHERE regexp_matches(word, '^[a-z]{{4,}}$') AND word NOT IN (SELECT word FROM vocabulary)),
    unknown_keys AS (
      SELECT word, unnest(list_distinct(list_append(list_transform(range(1, len(word) + 1),
             lambda i: word[:i-1] || word[i+1:]), word))) AS k FROM unknown),
    known_keys AS (
      SELECT word AS candidate, freq, unnest(list_distinct(list_append(list_transform(range(1, len(word) + 1),
             lambda i: word[:i-1] || word[i+1:]), word))) AS k FROM vocabulary),
    pairs AS (SELECT DISTINCT word, candidate, freq FROM unknown_keys JOIN known_keys USING (k)
              WHERE damerau_levenshtein(word, candidate) <= 1),
    corrections AS (
      SELECT word, candidate AS correction
      FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY freq DESC, candidate) AS rank FROM pairs) WHERE rank = 1)"""

# Words without a correction one edit away, and the best one at two.
CORRECTIONS_TWO = f"""{CORRECTIONS},
    far_words AS (
      SELECT word, k FROM unknown_keys
      WHERE word NOT IN (SELECT word FROM corrections) AND len(word) <= (SELECT max(len(word)) + 2 FROM vocabulary)),
    far_keys AS (
      SELECT DISTINCT word, unnest(list_append(list_transform(range(1, len(k) + 1), lambda i: k[:i-1] || k[i+1:]), k)) AS k2
      FROM far_words),
    vocabulary_keys AS (
      SELECT DISTINCT candidate, freq,
             unnest(list_append(list_transform(range(1, len(k) + 1), lambda i: k[:i-1] || k[i+1:]), k)) AS k2
      FROM known_keys),
    far_pairs AS (
      SELECT word, candidate, freq
      FROM (SELECT DISTINCT word, candidate, freq FROM far_keys JOIN vocabulary_keys USING (k2))
      WHERE damerau_levenshtein(word, candidate) = 2),
    corrections_two AS (
      FROM corrections UNION ALL
      SELECT word, candidate AS correction
      FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY freq DESC, candidate) AS rank FROM far_pairs) WHERE rank = 1)"""

FREQUENT_PHRASES = f""",
    document_words AS (SELECT doc_id, {words("lower(coalesce(text, ''))")} AS ws FROM documents),
    frequent AS (
      SELECT phrase, count(*) AS freq
      FROM (SELECT unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS phrase FROM document_words)
      GROUP BY phrase HAVING count(*) >= 20)"""

REVIEW_COLUMNS = ["review_id", "beer_name", "style", "rating_overall", "text"]

ORACLE: dict[str, str] = {
    "csv_roundtrip": over_reviews("SELECT * FROM reviews"),
    "csv_split_roundtrip": over_reviews("SELECT * FROM reviews"),
    "first_n_reviews": over_reviews("SELECT * FROM reviews ORDER BY review_id LIMIT 100"),
    "null_profile": over_reviews(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS n_rows, 5 AS n_columns, count(*) - count({c}) AS n_null FROM reviews"
            for c in REVIEW_COLUMNS
        )
    ),
    "preview": over_reviews(
        f"""SELECT review_id, beer_name, substring(text, 1, 120) AS text,
                   substring(lower({collapse('text')}), 1, 120) AS clean_text
            FROM reviews ORDER BY review_id LIMIT 3"""
    ),
    "strip_html": f"SELECT page_id, {strip_html('html')} AS text FROM pages",
    # Whatever is never closed is dropped: the texts are those of the pages without it.
    "strip_unclosed": f"SELECT page_id, {strip_html('html')} AS text FROM pages",
    "expand_contractions": text_query(expand_contractions("text")),
    "strip_emails_urls": text_query(strip_emails_urls("text")),
    "squeeze_repeats": over_reviews(
        f"SELECT review_id, {squeeze('cs')} AS text FROM (SELECT review_id, string_split(text, '') AS cs FROM reviews)"
    ),
    "strip_specials": text_query(strip_specials("text")),
    "normalize_light": text_query(f"lower({collapse('text')})"),
    "content_tokens": over_reviews(
        f"""SELECT review_id, {lemmas_of("ws")} AS text
            FROM (SELECT review_id, list_filter({tokens(f"lower({collapse('text')})")},
                    lambda w: regexp_matches(w, '^\\p{{L}}+$') AND NOT list_contains({sql_list(STOP_WORDS)}, w)) AS ws
                  FROM reviews)"""
    ),
    "lemmatize": text_query(lemmas_of(words("text"))),
    "lemmatize_from_table": over_reviews(
        f"SELECT review_id, {lemmas_of(words("coalesce(text, '')"))} AS lemmas FROM reviews"
    ),
    "suffix_lemmas": over_reviews("SELECT word, lemma FROM ruled", SUFFIX_LEMMAS),
    "lemmatize_with_rules": over_reviews(
        f"""SELECT review_id, coalesce(string_agg(coalesce(lemma, w), ' ' ORDER BY i), '') AS lemmas
            FROM (SELECT review_id, unnest(ws) AS w, unnest(range(len(ws))) AS i
                  FROM (SELECT review_id, {words("coalesce(text, '')")} AS ws FROM reviews)
                  UNION ALL SELECT review_id, NULL, 0 FROM reviews WHERE len({words("coalesce(text, '')")}) = 0)
            LEFT JOIN (SELECT form, lemma FROM known UNION ALL SELECT word, lemma FROM ruled) ON form = lower(w)
            GROUP BY review_id""",
        SUFFIX_LEMMAS,
    ),
    "clean_reviews": over_reviews("SELECT review_id, cleaned_text FROM cleaned", cleaned("reviews")),
    "clean_translated": f"WITH {MEMORY}{TRANSLATED}{cleaned('translated')} SELECT review_id, cleaned_text FROM cleaned",
    "spell_corrections": over_reviews(
        "SELECT * FROM corrections",
        f", heard AS (SELECT DISTINCT unnest({tokens("coalesce(text, '')")}) AS word FROM reviews)" + CORRECTIONS,
    ),
    "correct_spelling": over_reviews(
        """SELECT review_id, coalesce(string_agg(coalesce(correction, word), ' ' ORDER BY i), '') AS corrected
           FROM word_rows LEFT JOIN corrections USING (word) GROUP BY review_id""",
        f""", word_lists AS (SELECT review_id, {words("coalesce(text, '')")} AS ws FROM reviews),
            word_rows AS (SELECT review_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM word_lists
                          UNION ALL SELECT review_id, '', 0 FROM word_lists WHERE len(ws) = 0),
            heard AS (SELECT DISTINCT word FROM word_rows)"""
        + CORRECTIONS,
    ),
    "spell_corrections_two": over_reviews(
        "SELECT * FROM corrections_two",
        f", heard AS (SELECT DISTINCT unnest({tokens("coalesce(text, '')")}) AS word FROM reviews)" + CORRECTIONS_TWO,
    ),
    "correct_spelling_two": over_reviews(
        """SELECT review_id, coalesce(string_agg(coalesce(correction, word), ' ' ORDER BY i), '') AS corrected
           FROM word_rows LEFT JOIN corrections_two USING (word) GROUP BY review_id""",
        f""", word_lists AS (SELECT review_id, {words("coalesce(text, '')")} AS ws FROM reviews),
            word_rows AS (SELECT review_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM word_lists
                          UNION ALL SELECT review_id, '', 0 FROM word_lists WHERE len(ws) = 0),
            heard AS (SELECT DISTINCT word FROM word_rows)"""
        + CORRECTIONS_TWO,
    ),
    "clean_spelled": over_reviews(
        """SELECT review_id, coalesce(string_agg(coalesce(correction, word), ' ' ORDER BY i), '') AS cleaned_text
           FROM word_rows LEFT JOIN corrections USING (word) GROUP BY review_id""",
        cleaned("reviews")
        + f""", word_lists AS (SELECT review_id, {words("cleaned_text")} AS ws FROM cleaned),
            word_rows AS (SELECT review_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM word_lists
                          UNION ALL SELECT review_id, '', 0 FROM word_lists WHERE len(ws) = 0),
            heard AS (SELECT DISTINCT word FROM word_rows)"""
        + CORRECTIONS,
    ),
    "process_translated": f"""WITH {MEMORY}{TRANSLATED}{cleaned('translated')}{matches('cleaned', 'plain')},
    counted AS (SELECT review_id, {COUNTS} FROM hits GROUP BY review_id)
      SELECT r.review_id, r.beer_name, r.style, r.rating_overall, r.text, c.cleaned_text,
             {", ".join(f"coalesce(n.aspect_{c}, 0) AS aspect_{c}" for c in CATEGORIES)}
      FROM reviews r JOIN cleaned c USING (review_id) LEFT JOIN counted n USING (review_id)""",
    "detect_japanese": over_reviews(
        f"SELECT review_id, coalesce(regexp_matches(text, '{JAPANESE}'), false) AS needs_translation FROM reviews"
    ),
    "language_counts": over_reviews(
        f"""SELECT CASE WHEN regexp_matches(text, '{JAPANESE}') THEN 'ja' ELSE 'en' END AS language, count(*) AS n
            FROM reviews GROUP BY 1"""
    ),
    "translate_memory": f"WITH {MEMORY}{TRANSLATED} SELECT review_id, text FROM translated",
    "missing_translations": f"""WITH {MEMORY} SELECT DISTINCT text AS source_text FROM reviews
        WHERE regexp_matches(text, '{JAPANESE}') AND text NOT IN (SELECT source_text FROM memory WHERE translated <> '')""",
    "mixed_language": mixed("review_id", 20),
    "mixed_language_sampled": mixed("md5(concat('42:', review_id)), review_id", 500),
    "aspect_token_matches": over_reviews("SELECT * FROM token_hits", matches("reviews", "text")),
    "aspect_phrase_matches": over_reviews("SELECT * FROM phrase_hits", matches("reviews", "text")),
    "frequent_phrases": over_reviews("SELECT * FROM frequent", FREQUENT_PHRASES),
    "aspect_phrase_index": over_reviews(
        """SELECT review_id, left(phrase, 1) AS category, phrase AS match_text, phrase AS lemma,
                  CAST(-1 AS INTEGER) AS token_index
           FROM reviews, frequent WHERE contains(lower(coalesce(text, '')), phrase)""",
        FREQUENT_PHRASES,
    ),
    "aspect_nested": over_reviews(
        f"""SELECT review_id, category, CAST(count(match_text) AS INTEGER) AS n,
                   coalesce(string_agg(match_text || '/' || lemma || '@' || token_index, ' ' ORDER BY late, token_index), '') AS matches
            FROM (SELECT review_id, category FROM reviews, (VALUES {values([(c,) for c in CATEGORIES])}) AS c(category))
            LEFT JOIN hits USING (review_id, category) GROUP BY review_id, category""",
        matches("reviews", "text"),
    ),
    "process_reviews": over_reviews("SELECT * FROM processed", PROCESSED),
    "aspect_coverage": over_reviews(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS aspect, count(*) FILTER (WHERE aspect_{c} > 0) AS reviews, count(*) AS total,
                       round(count(*) FILTER (WHERE aspect_{c} > 0) * 100.0 / count(*), 6) AS percent FROM processed"""
            for c in CATEGORIES
        ),
        PROCESSED,
    ),
    "top_styles_mouthfeel": over_reviews(
        """SELECT style, round(avg(aspect_mouthfeel_texture), 6) AS mean_mentions FROM processed
           GROUP BY style ORDER BY mean_mentions DESC, style LIMIT 5""",
        PROCESSED,
    ),
    "aspect_lemmas": over_reviews(
        """SELECT review_id, category, CAST(count(*) AS INTEGER) AS n, string_agg(lemma, ',' ORDER BY late, token_index) AS lemmas
           FROM hits GROUP BY review_id, category""",
        matches("reviews", "text"),
    ),
    "aspect_pairs": over_reviews(
        "SELECT category, match_text, lemma, count(*) AS n FROM hits GROUP BY ALL", matches("reviews", "text")
    ),
    "label_sentiment": over_reviews(
        f"SELECT review_id, sentiment, code AS label, sentiment AS label_name FROM labelled JOIN (VALUES {LABEL_VALUES}) AS l(name, code) ON name = sentiment",
        LABELLED,
    ),
    "label_distribution": over_reviews(
        """SELECT sentiment, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent
           FROM labelled GROUP BY sentiment""",
        LABELLED,
    ),
    "stratified_split": over_reviews("SELECT review_id, sentiment, split FROM split", RANKED),
    "stratified_folds": over_reviews(
        "SELECT review_id, sentiment, CAST((rank - 1) % 3 AS INTEGER) AS fold FROM ranked", RANKED
    ),
    "seeded_sample": over_reviews("SELECT * FROM reviews ORDER BY md5(concat('42:', review_id)), review_id LIMIT 500"),
    "tfidf_vocabulary": over_reviews(
        "SELECT term, term_count, doc_freq, round(idf, 6) AS idf FROM vocabulary", RANKED + GRAMS
    ),
    "tfidf_weights": over_reviews(
        """SELECT review_id, term, tf, round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY review_id)), 6) AS tfidf
           FROM counts JOIN vocabulary USING (term)""",
        RANKED + GRAMS,
    ),
    "baseline_optimum": over_reviews(
        """SELECT sentiment AS label, count(*) AS n_train, round(1.0 / count(*) OVER (), 3) AS mean_probability,
                  true AS converged
           FROM split WHERE split = 'train' GROUP BY sentiment""",
        RANKED,
    ),
    "baseline_test_rows": over_reviews(
        "SELECT review_id, sentiment AS true_label, true AS label_known FROM split WHERE split = 'test'", RANKED
    ),
    "grid_combinations": over_reviews(
        """, trained AS (SELECT sentiment, row_number() OVER (PARTITION BY sentiment ORDER BY md5(concat('42:', review_id)), review_id) - 1 AS r
                      FROM split WHERE split = 'train'),
           folds AS (SELECT CAST(r % 3 AS INTEGER) AS fold, count(*) AS n FROM trained GROUP BY ALL)
           SELECT solver, CAST(c AS DOUBLE) AS c, fold, n AS n_held_out, true AS scored, true AS chosen_is_best
           FROM folds, (VALUES ('multinomial'), ('one_vs_rest')) s(solver), (VALUES (0.1), (1.0), (10.0)) g(c)""",
        RANKED,
    ),
    "class_weights": over_reviews(
        """SELECT sentiment, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
           FROM labelled GROUP BY sentiment""",
        LABELLED,
    ),
    "normalize_labels": f"""WITH {PREDICTIONS} SELECT review_id, {normalized('raw_pred_a')} AS pred_a,
        {normalized('raw_pred_b')} AS pred_b, upper(raw_pred_b[1]) || lower(raw_pred_b[2:]) AS capitalized_b FROM predictions""",
    "keyword_sentiment": over_reviews(
        f"""SELECT review_id, {keyword_rule("coalesce(text, '')")} AS pred_label FROM reviews"""
    ),
    "score_batches": over_reviews(
        f"""SELECT review_id, {keyword_rule("coalesce(text, '')")} AS pred_label FROM reviews"""
    ),
    "scored_from_store": over_reviews(
        f"""SELECT review_id, {keyword_rule("coalesce(text, '')")} AS pred_label,
                   coalesce(text, '') IN (SELECT coalesce(text, '') FROM reviews WHERE rating_overall >= 4.0) AS scored_before
            FROM reviews"""
    ),
    "classification_report": f"""WITH {PREDICTED}{scores('pred_a', 's')}
        SELECT label, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM s
        UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM s
        UNION ALL SELECT 'macro avg', round(avg("precision"), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM s
        UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                         round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM s""",
    "confusion_matrix": f"""WITH {PREDICTED} SELECT label AS true_label,
        {", ".join(f"count(*) FILTER (WHERE pred_a = '{x}') AS pred_{x}" for x in LABELS)}
        FROM (VALUES {LABEL_VALUES}) AS l(label, code) LEFT JOIN predicted ON true_label = label GROUP BY label""",
    "errors": f"""WITH {PREDICTED} SELECT review_id, text, true_label, pred_a AS pred_label FROM predicted
        WHERE true_label <> pred_a""",
    "error_rate": f"""WITH {PREDICTED} SELECT count(*) AS n_rows, count(*) FILTER (WHERE true_label <> pred_a) AS n_errors,
        round(count(*) FILTER (WHERE true_label <> pred_a) * 100.0 / count(*), 6) AS error_percent FROM predicted""",
    "keyword_gap": f"""WITH {PREDICTED},
        found AS (SELECT keyword, p.*, row_number() OVER (PARTITION BY keyword ORDER BY review_id) AS rank
                  FROM (VALUES {KEYWORDS}) AS k(keyword), predicted p
                  WHERE true_label <> pred_a AND contains(lower(text), keyword)),
        counted AS (SELECT keyword, count(*) AS n_errors FROM found GROUP BY keyword)
        SELECT k.keyword, coalesce(c.n_errors, 0) AS n_errors, f.review_id AS example_id, substring(f.text, 1, 180) AS snippet,
               f.true_label, f.pred_a AS pred_label
        FROM (VALUES {KEYWORDS}) AS k(keyword) LEFT JOIN counted c USING (keyword)
        LEFT JOIN (SELECT * FROM found WHERE rank = 1) f USING (keyword)""",
    "sampled_error_analysis": over_reviews(
        f"""SELECT k.keyword, count(s.review_id) AS n_errors, min(s.review_id) AS example_id,
                   min_by(substring(s.text, 1, 180), s.review_id) AS snippet,
                   min_by(s.sentiment, s.review_id) AS true_label, min_by(s.pred, s.review_id) AS pred_label
            FROM (VALUES {KEYWORDS}) AS k(keyword) LEFT JOIN scored s
              ON s.sentiment <> s.pred AND contains(lower(s.text), k.keyword) GROUP BY k.keyword""",
        LABELLED
        + f""", scored AS (SELECT *, {keyword_rule("coalesce(text, '')")} AS pred FROM labelled
                           ORDER BY md5(concat('42:', review_id)), review_id LIMIT 500)""",
    ),
    "gap_comparison": f"""WITH {PREDICTED},
        g AS (SELECT keyword, count(*) FILTER (WHERE true_label <> pred_a) AS errors_a,
                     count(*) FILTER (WHERE true_label <> pred_b) AS errors_b
              FROM (VALUES {KEYWORDS}) AS k(keyword) LEFT JOIN predicted ON contains(lower(text), keyword) GROUP BY keyword),
        t AS (SELECT count(*) AS n FROM predicted)
        SELECT keyword, errors_a, errors_b, round(errors_a * 1000.0 / n, 6) AS per_1000_a, round(errors_b * 1000.0 / n, 6) AS per_1000_b,
               CASE WHEN errors_a > 0 THEN round(1.0 - errors_b / errors_a, 6) END AS reduction FROM g, t""",
    "model_comparison": f"""WITH {PREDICTED}{scores('pred_a', 'sa')}{scores('pred_b', 'sb')}
        SELECT 'a' AS model, round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
               round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM sa
        UNION ALL SELECT 'b', round(sum(tp) / sum(support), 6), round(avg(f1), 6), round(sum(f1 * support) / sum(support), 6) FROM sb""",
}
