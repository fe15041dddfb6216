import os
import time

import pytest
from pyspark.sql import functions as F

from sipnote.functions import labels as L
from sipnote.operators import evaluation as E
from sipnote.operators.features import class_weights, label_distribution, with_class_weights
from sipnote.operators.profile import null_profile, preview
from sipnote.operators.scoring import score_batches


def test_label_sentiment(spark):
    ratings = [4.0, 3.99, 2.5, 2.51, 5.0, 0.0, float("nan"), None]
    df = spark.createDataFrame([(r,) for r in ratings], "r double").coalesce(1)
    label = L.label_sentiment(F.col("r"))
    got = df.select(label.alias("l"), L.label_code(label).alias("c"), L.label_name(L.label_code(label)).alias("n")).collect()
    assert [r.l for r in got] == [
        "Positive", "Neutral", "Negative", "Neutral", "Positive", "Negative", "Neutral", "Neutral",
    ]
    assert [r.c for r in got] == [2, 1, 0, 1, 2, 0, 1, 1] and all(r.l == r.n for r in got)


def test_label_names(apply):
    assert apply(L.normalize_label, "LABEL_0", "LABEL_2", "neutral", "Positive", "odd", None) == [
        "Negative", "Positive", "Neutral", "Positive", "odd", None,
    ]
    assert apply(L.capitalize_label, "positive", "nEUTRAL", "") == ["Positive", "Neutral", ""]
    assert apply(L.keyword_sentiment, "flat but good", "damaged", "gorgeous", "Flat", None) == [
        "Neutral", "Negative", "Positive", "Neutral", "Neutral",
    ]


@pytest.fixture
def scored(spark):
    rows = [
        (1, "Good MOUTHFEEL and lacing " + "x" * 300, "Positive", "Positive", "Negative"),
        (2, "hoppy mouthfeel", "Positive", "Negative", "Positive"),
        (3, None, "Negative", "Negative", "Negative"),
        (4, "lacing", "Negative", "odd", "Negative"),
        (5, "Mouthfeel", "Positive", "Negative", "Positive"),
    ]
    return spark.createDataFrame(rows, "review_id long, text string, t string, a string, b string")


def test_report(scored):
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in E.classification_report(scored, "t", "a").collect()}
    assert got["Positive"] == (1.0, round(1 / 3, 6), 0.5, 3)
    assert got["Negative"] == (round(1 / 3, 6), 0.5, 0.4, 2)
    assert got["Neutral"] == (0.0, 0.0, 0.0, 0)
    assert got["accuracy"] == (None, None, 0.4, 5)
    assert got["macro avg"][2] == 0.3 and got["weighted avg"][2] == 0.46


def test_confusion_matrix(scored):
    rows = E.confusion_matrix(scored, "t", "a").collect()
    assert [tuple(r) for r in rows] == [("Negative", 1, 0, 0), ("Neutral", 0, 0, 0), ("Positive", 2, 0, 1)]


def test_errors_and_gaps(scored):
    assert sorted(r.review_id for r in E.errors(scored, "t", "a").collect()) == [2, 4, 5]
    assert tuple(E.error_rate(scored, "t", "a").first()) == (5, 3, 60.0)
    assert tuple(E.error_rate(scored.limit(0), "t", "a").first()) == (0, 0, 0.0)
    gap = {r.keyword: r for r in E.keyword_gap(E.errors(scored, "t", "a"), "review_id", "text", "t", "a").collect()}
    assert (gap["mouthfeel"].n_errors, gap["mouthfeel"].example_id, gap["mouthfeel"].snippet) == (2, 2, "hoppy mouthfeel")
    assert gap["skunky"].n_errors == 0 and gap["skunky"].example_id is None and len(gap) == 7
    both = {r.keyword: (r.errors_a, r.errors_b, r.per_1000_a, r.reduction) for r in E.gap_comparison(scored, "text", "t", "a", "b").collect()}
    assert both["mouthfeel"] == (2, 1, 400.0, 0.5) and both["skunky"] == (0, 0, 0.0, None)
    models = {r.model: r.accuracy for r in E.model_comparison(scored, "t", {"a": "a", "b": "b"}).collect()}
    assert models == {"a": 0.4, "b": 0.8}


def test_class_shares(spark):
    df = spark.createDataFrame([("x",)] * 6 + [("y",)] * 2, "label string")
    assert {r.label: r.weight for r in class_weights(df, "label").collect()} == {"x": 8 / 12, "y": 2.0}
    assert {r.label: r.percent for r in label_distribution(df, "label").collect()} == {"x": 75.0, "y": 25.0}
    assert with_class_weights(df, "label").agg(F.round(F.sum("weight"), 9)).first()[0] == 8.0


def test_null_profile_and_preview(spark):
    df = spark.createDataFrame([(2, "bb", None), (1, "aaaa", None)], "id long, a string, b string")
    got = {r.column_name: (r.n_rows, r.n_columns, r.n_null) for r in null_profile(df).collect()}
    assert got == {"id": (2, 3, 0), "a": (2, 3, 0), "b": (2, 3, 2)}
    assert [tuple(r) for r in preview(df, "id", 1, ["a"], 3).collect()] == [(1, None, "aaa")]


def test_scorer_gets_small_batches_and_no_nulls(texts):
    def load():
        def score(batch):
            assert len(batch) <= 3 and all(isinstance(t, str) for t in batch)
            return [str(len(t)) for t in batch]

        return score

    rows = score_batches(texts("a", None, "ccc", "dd", "e" * 5000), "text", "n", load, batch_size=3).collect()
    assert {r.review_id: r.n for r in rows} == {0: "1", 1: "0", 2: "3", 3: "2", 4: "5000"}


def test_error_analysis_scores_each_row_of_the_sample_once(spark, tmp_path):
    from sipnote.plans.error_analysis import analyse_errors

    calls = tmp_path / "calls"
    calls.mkdir()

    def load():
        def score(batch):
            for text in batch:
                (calls / f"{text}-{os.getpid()}-{time.time_ns()}").touch()
            return ["Positive" if text.endswith("1") else "Negative" for text in batch]

        return score

    rows = [(i, f"t{i}", "Positive") for i in range(400)]
    df = spark.createDataFrame(rows, "review_id long, text string, sentiment string")
    found = analyse_errors(score_batches(df, "text", "pred", load), "sentiment", "pred", sample_size=100)
    for part in (found.report, found.matrix, found.rate, found.errors, found.gaps):
        part.collect()
    assert found.sample.count() == 100 and len(list(calls.iterdir())) == 100
