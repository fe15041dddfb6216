from pyspark.sql import functions as F

from sipnote.functions.aspects import AspectLexicon
from sipnote.functions.cleaning import CleanOptions
from sipnote.operators import aspects as A
from sipnote.plans.process import process_reviews
from tests.conftest import plan_of


def nested(texts, *values):
    rows = A.with_nested_aspects(texts(*values), "text").collect()
    return [r.aspects for r in sorted(rows, key=lambda r: r.review_id)]


def lemmas(aspect):
    return [m.lemma for m in aspect["matches"]]


def test_known_review(texts):
    text = "Ordered on a whim: thin and watery, though the flavor was sweet. Cheap bottle."
    (got,) = nested(texts, text)
    assert lemmas(got["mouthfeel_texture"]) == ["thin", "watery"]
    assert lemmas(got["taste_flavor"]) == ["flavor", "sweet"]
    assert got["appearance"]["count"] == 0 and got["appearance"]["matches"] == []


def test_phrases(texts):
    hyphen, fruit, repeated, none, missing = nested(
        texts,
        "We bought one six-pack too many.",
        "Some dark fruit, faint notes",
        "six-pack six-pack",
        "",
        None,
    )
    assert lemmas(hyphen["packaging_price"]) == ["buy", "six-pack"]
    assert hyphen["packaging_price"]["matches"][1]["index"] == -1
    assert sorted(lemmas(fruit["taste_flavor"])) == ["dark fruit", "notes"]
    assert lemmas(fruit["appearance"]) == ["dark"]
    assert repeated["packaging_price"]["count"] == 1
    for empty in (none, missing):
        assert {c: a["count"] for c, a in empty.items()} == dict.fromkeys(AspectLexicon().categories, 0)


def test_table_path_loses_hyphens(texts):
    row = process_reviews(texts("A six-pack, poured thick & Creamy; cans can't be light-bodied.")).first()
    assert row.cleaned_text == "A sixpack pour thick Creamy can cannot be lightbodied"
    assert (row.aspect_packaging_price, row.aspect_mouthfeel_texture, row.aspect_appearance) == (1, 2, 1)
    kept = process_reviews(texts("A six-pack, poured."), CleanOptions(special_chars=False)).first()
    assert (kept.aspect_packaging_price, kept.aspect_appearance) == (1, 1)


def test_counts_agree_with_matches(texts):
    df = texts("Hoppy HOPS, thin body; can can", "“Thin” crisp…", None)
    counted = A.with_aspect_counts(df, "text").collect()
    per_row = {
        (r.review_id, r.category): r.n
        for r in A.all_matches(df, "review_id", "text").groupBy("review_id", "category").agg(F.count("*").alias("n")).collect()
    }
    for row in counted:
        for c in AspectLexicon().categories:
            assert row[f"aspect_{c}"] == per_row.get((row.review_id, c), 0)


def test_own_lexicon_last_category_wins(texts):
    lexicon = AspectLexicon(terms={"a": ["foam", "x"], "b": ["foam"]}, lemmas={"foams": "foam"})
    row = A.with_aspect_counts(texts("Foams foam x"), "text", lexicon=lexicon).first()
    assert (row.aspect_a, row.aspect_b) == (1, 2)


def test_coverage_and_top_styles(spark):
    columns = A.count_columns()
    rows = [("s1", 1, 2, 0, 0), ("s1", 0, 0, 0, 0), ("s2", 0, 3, 0, 1), ("s3", 0, 1, 0, 0)]
    df = spark.createDataFrame(rows, ["style", *columns])
    got = {r.aspect: (r.reviews, r.total, r.percent) for r in A.aspect_coverage(df).collect()}
    assert got["mouthfeel_texture"] == (3, 4, 75.0) and got["appearance"] == (0, 4, 0.0)
    top = A.top_styles(df, "aspect_mouthfeel_texture", 2).collect()
    assert [(r.style, r.mean_mentions) for r in top] == [("s2", 3.0), ("s1", 1.0)]
    empty = A.aspect_coverage(df.limit(0)).collect()
    assert [(r.reviews, r.percent) for r in empty] == [(0, None)] * 4


def test_processing_needs_no_shuffle(texts):
    assert "Exchange" not in plan_of(process_reviews(texts("a", "b")))
