"""Scores kept in a store: each distinct text is scored once over all runs."""

import pytest

from sipnote.operators.scoring import score_with_store, stored_scores
from tests.conftest import plan_of


@pytest.fixture
def scorer(tmp_path):
    """A loader whose scorer notes every batch it is given, and a reader of these notes."""
    notes = str(tmp_path / "notes")

    def load():
        def label(texts):
            with open(notes, "a") as f:
                f.write("|".join(texts) + "\n")
            return [None if t == "odd" else str(len(t)) for t in texts]

        return label

    def batches():
        with open(notes) as f:
            return [line.rstrip("\n").split("|") for line in f]

    return load, batches


def scored(df, load, store, model="m1", **options):
    got = score_with_store(df, "review_id", "text", "label", load, store, model, **options)
    return sorted(tuple(r) for r in got.select("review_id", "label").collect())


def test_calls_equal_the_distinct_new_texts(texts, scorer, tmp_path):
    load, batches = scorer
    store = str(tmp_path / "store")
    first = texts("a", "bb", "bb", None, "", "odd", *["hot"] * 50)
    expected = [(0, "1"), (1, "2"), (2, "2"), (3, "0"), (4, "0"), (5, None)] + [(i, "3") for i in range(6, 56)]
    assert scored(first, load, store) == expected
    assert sorted(sum(batches(), [])) == ["", "a", "bb", "hot", "odd"]
    # The second run asks for what is new alone; a broadcast limit of 0 takes the shuffled look-up.
    assert scored(texts("ccc", "bb", "odd", "hot", "ccc"), load, store, limit=0) == [
        (0, "3"), (1, "2"), (2, None), (3, "3"), (4, "3")
    ]
    assert sorted(sum(batches(), [])) == ["", "a", "bb", "ccc", "hot", "odd"]
    # Another model has scores of its own.
    assert scored(texts("a"), load, store, "m2") == [(0, "1")]
    assert len(sum(batches(), [])) == 7


def test_batches_hold_texts_of_like_length(spark, scorer, tmp_path):
    load, batches = scorer
    df = spark.createDataFrame([(i, "x" * (1 + i * 37 % 100)) for i in range(100)], "review_id long, text string")
    scored(df, load, str(tmp_path / "store"), batch_size=8)
    lengths = [[len(t) for t in batch] for batch in batches()]
    assert sum(map(len, lengths)) == 100 and all(len(batch) <= 8 and batch == sorted(batch) for batch in lengths)


def test_empty_tables_repeated_keys_and_clashing_names(spark, scorer, tmp_path):
    load, _ = scorer
    store = str(tmp_path / "store")
    df = spark.createDataFrame(
        [(None, "a", "p", "x"), (1, "a", "q", "y"), (1, "bb", "r", "z")],
        "review_id long, text string, model string, label string",
    )
    assert score_with_store(df.limit(0), "review_id", "text", "label", load, store, "m").count() == 0
    got = score_with_store(df, "review_id", "text", "label", load, store, "m")
    assert got.columns == ["review_id", "text", "model", "label"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == [(1, "a", "q", "1"), (1, "bb", "r", "2"), (None, "a", "p", "1")]
    assert sorted(r.label for r in stored_scores(spark, store, "m").collect()) == ["1", "2"]
    assert "CartesianProduct" not in plan_of(got)
