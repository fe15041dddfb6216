"""Every operator as a query over the given tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sipnote.checks.fixtures import predictions, reviews, table, translation_memory
from sipnote.functions import labels as L
from sipnote.functions import text as T
from sipnote.functions.fixed_values import COMPLAINT_WORDS, LABELS, PRAISE_WORDS, SOFTENING_WORDS
from sipnote.functions.cleaning import CleanOptions
from sipnote.functions.language import needs_translation
from sipnote.functions.word_tables import LEMMAS, STOP_WORDS
from sipnote.operators import aspects as A
from sipnote.operators import evaluation as E
from sipnote.operators import features as X
from sipnote.operators import phrases, profile, ranking, spelling, suffix_rules, translation
from sipnote.operators.lemmatize import lemmatize_with_table
from sipnote.operators.lookup import lookup
from sipnote.operators.scoring import score_batches, score_with_store, stored_scores
from sipnote.plans import modeling
from sipnote.plans.error_analysis import analyse_errors
from sipnote.plans.process import clean_reviews, process_reviews
from sipnote.session import new_path, written
from sipnote.sources.tables import read_reviews_csv, spread, write_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Text of one CSV file of ``csv_split_roundtrip``, some more where the tasks before are larger.
CSV_FILE_BYTES = 256 << 20


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _text_query(column: Callable) -> Query:
    return lambda spark, sf: reviews(spark, sf).select("review_id", column(F.col("text")).alias("text"))


# Sources and sinks


@query
def csv_roundtrip(spark, sf):
    path = new_path(spark, "reviews-csv")
    # Columns are found by the header, in any order.
    write_csv(reviews(spark, sf).select("text", "style", "rating_overall", "review_id", "beer_name"), path)
    return read_reviews_csv(spark, path)


@query
def csv_split_roundtrip(spark, sf):
    path = new_path(spark, "reviews-csv")
    rows = reviews(spark, sf).select("text", "style", "rating_overall", "review_id", "beer_name")
    # Files larger than a split, each written by one task and read by as many as its size asks for.
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    write_csv(rows.coalesce(1 + size // CSV_FILE_BYTES), path)
    return read_reviews_csv(spark, path, split_files=True)


@query
def first_n_reviews(spark, sf):
    return ranking.first_n(reviews(spark, sf), "review_id", 100)


@query
def null_profile(spark, sf):
    return profile.null_profile(reviews(spark, sf))


@query
def preview(spark, sf):
    rows = reviews(spark, sf).select(
        "review_id", "beer_name", "text", T.normalize_light(F.col("text")).alias("clean_text")
    )
    return profile.preview(rows, "review_id", 3, ["text", "clean_text"], 120)


# Cleaning


@query
def strip_html(spark, sf):
    pages = spread(table(spark, sf, "pages"))
    return pages.select("page_id", T.strip_html(F.col("html")).alias("text"))


@query
def strip_unclosed(spark, sf):
    """Pages with an element behind them that is never closed; nothing of it may be left."""
    pages = spread(table(spark, sf, "pages"))
    kind = F.col("page_id") % 4
    unclosed = (
        F.when(kind == 0, "<script async>if (a < b) { write('<p>x</p> <!-- y -->') }")
        .when(kind == 1, "<STYLE media='print'>p > a { color: red } <script>z()</script>")
        .when(kind == 2, "<!-- <b>note</b> <script>w()</script> to be closed --")
        .otherwise("")
    )
    return pages.select("page_id", T.strip_html(F.concat("html", unclosed)).alias("text"))


QUERIES["expand_contractions"] = _text_query(T.expand_contractions)
QUERIES["strip_emails_urls"] = _text_query(T.strip_emails_urls)
QUERIES["squeeze_repeats"] = _text_query(T.squeeze_repeats)
QUERIES["strip_specials"] = _text_query(T.strip_specials)
QUERIES["normalize_light"] = _text_query(T.normalize_light)
QUERIES["content_tokens"] = _text_query(lambda c: T.content_tokens(c, LEMMAS, STOP_WORDS))
QUERIES["lemmatize"] = _text_query(lambda c: T.lemmatize_words(c, LEMMAS))


@query
def lemmatize_from_table(spark, sf):
    forms = F.explode(F.map_entries(T.literal_map(LEMMAS)))
    lemmas = spark.range(1).select(forms.alias("e")).select(F.col("e.key").alias("form"), F.col("e.value").alias("lemma"))
    rows = reviews(spark, sf).select("review_id", "text")
    return lemmatize_with_table(rows, lemmas, "review_id", "text", "lemmas").select("review_id", "lemmas")


def _lemma_table(spark):
    forms = F.explode(T.literal_map(LEMMAS))
    return spark.range(1).select(forms.alias("form", "lemma"))


@query
def suffix_lemmas(spark, sf):
    """What the rules make of the reviews' words that the table does not hold."""
    text = F.lower(F.coalesce(F.col("text"), F.lit("")))
    words = reviews(spark, sf).select(F.explode(T.split_words(text)).alias("word")).distinct()
    lemmas = _lemma_table(spark)
    return suffix_rules.ruled_lemmas(words, lemmas, written(suffix_rules.suffix_rules(lemmas), "suffix-rules"))


@query
def lemmatize_with_rules(spark, sf):
    rows = spread(reviews(spark, sf).select("review_id", "text"))
    done = suffix_rules.lemmatize_with_rules(rows, _lemma_table(spark), "review_id", "text", "lemmas")
    return done.select("review_id", "lemmas")


@query
def clean_reviews_table(spark, sf):
    return clean_reviews(reviews(spark, sf)).select("review_id", "cleaned_text")


@query
def clean_translated(spark, sf):
    cleaned = clean_reviews(reviews(spark, sf), memory=translation_memory(spark, sf))
    return cleaned.select("review_id", "cleaned_text")


def _vocabulary(spark, sf):
    # Of all languages, as the reviews are: else words of one would be corrected into another.
    return written(spelling.word_frequencies(spread(table(spark, sf, "documents")), "text", 20), "vocabulary")


@query
def spell_corrections(spark, sf):
    words = spelling.distinct_words(reviews(spark, sf), "text")
    return spelling.spell_corrections(words, _vocabulary(spark, sf))


@query
def correct_spelling(spark, sf):
    rows = reviews(spark, sf).select("review_id", "text")
    corrected = spelling.correct_spelling(rows, _vocabulary(spark, sf), "review_id", "text", "corrected")
    return corrected.select("review_id", "corrected")


@query
def spell_corrections_two(spark, sf):
    words = spelling.distinct_words(reviews(spark, sf), "text")
    return spelling.spell_corrections(words, _vocabulary(spark, sf), edits=2)


@query
def correct_spelling_two(spark, sf):
    rows = reviews(spark, sf).select("review_id", "text")
    corrected = spelling.correct_spelling(rows, _vocabulary(spark, sf), "review_id", "text", "corrected", edits=2)
    return corrected.select("review_id", "corrected")


@query
def clean_spelled(spark, sf):
    options = CleanOptions(spellcheck=True)
    cleaned = clean_reviews(reviews(spark, sf), options, vocabulary=_vocabulary(spark, sf))
    return cleaned.select("review_id", "cleaned_text")


# Language


@query
def detect_japanese(spark, sf):
    return reviews(spark, sf).select("review_id", needs_translation(F.col("text")).alias("needs_translation"))


@query
def language_counts(spark, sf):
    return translation.language_counts(reviews(spark, sf))


@query
def translate_memory(spark, sf):
    rows = reviews(spark, sf).select("review_id", "text")
    return translation.translate_from_memory(rows, translation_memory(spark, sf))


@query
def missing_translations(spark, sf):
    return translation.missing_translations(reviews(spark, sf), translation_memory(spark, sf))


def _overlay(spark, sf):
    praised = reviews(spark, sf).where(F.col("rating_overall") >= 4.0)
    return praised.select("review_id", F.lit("これは美味しいビールです。").alias("text"))


@query
def mixed_language(spark, sf):
    rows = reviews(spark, sf).select("review_id", "text")
    return translation.mixed_language(rows, _overlay(spark, sf), 20)


@query
def mixed_language_sampled(spark, sf):
    rows = reviews(spark, sf).select("review_id", "text")
    return translation.mixed_language(rows, _overlay(spark, sf), 500, sampled=True)


# Aspects


@query
def aspect_token_matches(spark, sf):
    return A.token_matches(reviews(spark, sf), "review_id", "text")


@query
def aspect_phrase_matches(spark, sf):
    return A.phrase_matches(reviews(spark, sf), "review_id", "text")


@query
def frequent_phrases(spark, sf):
    return phrases.frequent_phrases(spread(table(spark, sf, "documents")), "text", 2, 20)


@query
def aspect_phrase_index(spark, sf):
    """Phrases of the documents, by the letter they begin with, looked for in the reviews."""
    found = phrases.frequent_phrases(spread(table(spark, sf, "documents")), "text", 2, 20)
    lexicon = found.select(F.left("phrase", F.lit(1)).alias("category"), "phrase")
    return phrases.phrase_matches_from_table(reviews(spark, sf), "review_id", "text", lexicon)


@query
def aspect_nested(spark, sf):
    """The nested map, read out again as one row per review and category."""
    nested = A.with_nested_aspects(reviews(spark, sf).select("review_id", "text"), "text")
    match = lambda m: F.concat(m["text"], F.lit("/"), m["lemma"], F.lit("@"), m["index"].cast("string"))
    # explode would add a filter on the map's size below, and compute the map a second time.
    entries = nested.select("review_id", F.explode_outer("aspects").alias("category", "aspect"))
    return entries.select(
        "review_id",
        "category",
        F.col("aspect.count").alias("n"),
        F.array_join(F.transform("aspect.matches", match), " ").alias("matches"),
    )


@query
def process_reviews_table(spark, sf):
    return process_reviews(reviews(spark, sf))


@query
def process_translated(spark, sf):
    return process_reviews(reviews(spark, sf), memory=translation_memory(spark, sf))


@query
def aspect_coverage(spark, sf):
    return A.aspect_coverage(process_reviews(reviews(spark, sf)))


@query
def top_styles_mouthfeel(spark, sf):
    return A.top_styles(process_reviews(reviews(spark, sf)), "aspect_mouthfeel_texture")


@query
def aspect_lemmas(spark, sf):
    return A.aspect_lemmas(reviews(spark, sf), "review_id", "text")


@query
def aspect_pairs(spark, sf):
    return A.aspect_pairs(reviews(spark, sf), "text")


# Labels, splits, samples


def _labelled(spark, sf):
    return reviews(spark, sf).withColumn("sentiment", L.label_sentiment(F.col("rating_overall")))


@query
def label_sentiment(spark, sf):
    labelled = _labelled(spark, sf).withColumn("label", L.label_code(F.col("sentiment")))
    return labelled.select("review_id", "sentiment", "label", L.label_name(F.col("label")).alias("label_name"))


@query
def label_distribution(spark, sf):
    return X.label_distribution(_labelled(spark, sf), "sentiment")


@query
def stratified_split(spark, sf):
    return ranking.stratified_split(_labelled(spark, sf), "review_id", "sentiment").select(
        "review_id", "sentiment", "split"
    )


@query
def stratified_folds(spark, sf):
    rows = _labelled(spark, sf).select("review_id", "sentiment")
    return ranking.stratified_folds(rows, "review_id", "sentiment", 3)


@query
def seeded_sample(spark, sf):
    return ranking.seeded_sample(reviews(spark, sf), "review_id", 500)


# Features and models


def _train(spark, sf):
    split = ranking.stratified_split(_labelled(spark, sf), "review_id", "sentiment")
    return split.where(F.col("split") == "train")


@query
def tfidf_vocabulary(spark, sf):
    terms = X.tfidf_vocabulary(_train(spark, sf), "text", 10_000)
    return terms.withColumn("idf", F.round("idf", 6))


@query
def tfidf_weights(spark, sf):
    vocabulary = written(X.tfidf_vocabulary(_train(spark, sf), "text", 10_000), "vocabulary")
    weights = X.tfidf_weights(reviews(spark, sf), "review_id", "text", vocabulary)
    return weights.withColumn("tfidf", F.round("tfidf", 6))


@query
def class_weights(spark, sf):
    return X.class_weights(_labelled(spark, sf), "sentiment").withColumn("weight", F.round("weight", 6))


def _prepared(spark, sf):
    """Cleaned, labelled and split reviews, written once as each fit reads them often."""
    return written(modeling.prepare(clean_reviews(reviews(spark, sf))), "prepared")


@query
def baseline_predictions(spark, sf):
    rows = _prepared(spark, sf)
    model = modeling.fit_baseline(rows.where(F.col("split") == "train"))
    tested = modeling.predict(model, rows.where(F.col("split") == "test"))
    return tested.select("review_id", F.col("sentiment").alias("true_label"), "pred_label")


@query
def baseline_optimum(spark, sf):
    """What the fit has to reach on the training rows, whatever way it takes there."""
    train = _prepared(spark, sf).where(F.col("split") == "train")
    return modeling.optimum(modeling.fit_baseline(train), train)


@query
def baseline_test_rows(spark, sf):
    """The rows of the test split and whether their prediction is one of the labels."""
    return baseline_predictions(spark, sf).select(
        "review_id", "true_label", F.col("pred_label").isin(LABELS).alias("label_known")
    )


@query
def baseline_report(spark, sf):
    return E.classification_report(baseline_predictions(spark, sf), "true_label", "pred_label")


@query
def grid_combinations(spark, sf):
    """Every combination of the grid with the rows held out of its fits, and whether the chosen one is the best."""
    result = modeling.grid_search(_prepared(spark, sf).where(F.col("split") == "train"))
    best = max(f1 for _, _, f1 in result.scores)
    kinds = {"LogisticRegressionModel": "multinomial", "OneVsRestModel": "one_vs_rest"}
    is_best = (*result.chosen, best) in result.scores and kinds[type(result.model.stages[-1]).__name__] == result.chosen[0]
    rows = [
        (solver, c, fold, n, 0 < f1 <= 1, is_best)
        for solver, c, f1 in result.scores
        for fold, n in enumerate(result.fold_rows)
    ]
    return spark.createDataFrame(rows, "solver string, c double, fold int, n_held_out long, scored boolean, chosen_is_best boolean")


@query
def grid_search(spark, sf):
    rows = _prepared(spark, sf)
    result = modeling.grid_search(rows.where(F.col("split") == "train"))
    tested = modeling.predict(result.model, rows.where(F.col("split") == "test"))
    return E.classification_report(tested, "sentiment", "pred_label")


def _predicted(spark, sf):
    return predictions(spark, sf).select(
        "review_id",
        "text",
        "true_label",
        L.normalize_label(F.col("raw_pred_a")).alias("pred_a"),
        L.normalize_label(F.col("raw_pred_b")).alias("pred_b"),
    )


@query
def normalize_labels(spark, sf):
    named = predictions(spark, sf)
    return named.select(
        "review_id",
        L.normalize_label(F.col("raw_pred_a")).alias("pred_a"),
        L.normalize_label(F.col("raw_pred_b")).alias("pred_b"),
        L.capitalize_label(F.col("raw_pred_b")).alias("capitalized_b"),
    )


@query
def keyword_sentiment(spark, sf):
    return reviews(spark, sf).select("review_id", L.keyword_sentiment(F.col("text")).alias("pred_label"))


def _keyword_scorer_loader():
    """A loader without references to this module, so that tasks need not have it installed."""
    complaints, softenings, praises = COMPLAINT_WORDS, SOFTENING_WORDS, PRAISE_WORDS

    def load():
        def label(text):
            if any(w in text for w in complaints):
                return "Neutral" if any(w in text for w in softenings) else "Negative"
            return "Positive" if any(w in text for w in praises) else "Neutral"

        return lambda texts: [label(t) for t in texts]

    return load


@query
def score_batches_table(spark, sf):
    rows = reviews(spark, sf).select("review_id", "text")
    return score_batches(rows, "text", "pred_label", _keyword_scorer_loader()).select("review_id", "pred_label")


@query
def scored_from_store(spark, sf):
    """All reviews scored by a store that a run over the praised ones has begun."""
    rows, store = reviews(spark, sf), new_path(spark, "scores")
    run = lambda df: score_with_store(df, "review_id", "text", "pred_label", _keyword_scorer_loader(), store, "keywords")
    run(rows.where(F.col("rating_overall") >= 4.0))
    before = written(stored_scores(spark, store, "keywords"), "scores-before").select("digest", F.lit(True).alias("before"))
    labelled = run(rows).withColumn("digest", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    found = lookup(labelled, before, "digest", ["review_id"])
    return found.select("review_id", "pred_label", F.coalesce("before", F.lit(False)).alias("scored_before"))


# Evaluation


@query
def classification_report(spark, sf):
    return E.classification_report(_predicted(spark, sf), "true_label", "pred_a")


@query
def confusion_matrix(spark, sf):
    return E.confusion_matrix(_predicted(spark, sf), "true_label", "pred_a")


@query
def errors(spark, sf):
    wrong = E.errors(_predicted(spark, sf), "true_label", "pred_a")
    return wrong.select("review_id", "text", "true_label", F.col("pred_a").alias("pred_label"))


@query
def error_rate(spark, sf):
    return E.error_rate(_predicted(spark, sf), "true_label", "pred_a")


@query
def keyword_gap(spark, sf):
    wrong = E.errors(_predicted(spark, sf), "true_label", "pred_a")
    return E.keyword_gap(wrong, "review_id", "text", "true_label", "pred_a")


@query
def sampled_error_analysis(spark, sf):
    """Keyword gaps of a scorer on a seeded sample of the labelled reviews."""
    rows = _labelled(spark, sf).select("review_id", "text", F.col("sentiment").alias("true_label"))
    scored = score_batches(rows, "text", "pred_label", _keyword_scorer_loader())
    return analyse_errors(scored, "true_label", "pred_label", sample_size=500).gaps


@query
def gap_comparison(spark, sf):
    return E.gap_comparison(_predicted(spark, sf), "text", "true_label", "pred_a", "pred_b")


@query
def model_comparison(spark, sf):
    return E.model_comparison(_predicted(spark, sf), "true_label", {"a": "pred_a", "b": "pred_b"})


# Names of the queries whose function shares its name with a library function.
QUERIES = {
    {
        "clean_reviews_table": "clean_reviews",
        "process_reviews_table": "process_reviews",
        "score_batches_table": "score_batches",
    }.get(name, name): function
    for name, function in QUERIES.items()
}
