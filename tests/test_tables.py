"""Look-ups, translation, lemmas and spelling from tables, with hot keys."""

import random

from pyspark.sql import functions as F

from sipnote.functions.text import lemmatize_words
from sipnote.operators import spelling as S
from sipnote.operators import translation as X
from sipnote.operators.lemmatize import lemmatize_with_table
from sipnote.operators.lookup import lookup, table_bytes
from sipnote.operators.words import replace_words
from tests.conftest import plan_of


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_salted_lookup_equals_broadcast(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    rows = spark.range(3000).withColumn("word", key)
    table = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(40)], "word string, value string")
    small = lookup(rows, table, "word", ["id"])
    salted = lookup(rows, table, "word", ["id"], limit=0, rows_per_task=100)
    # The hot key has 1000 rows, so ten salts: ten copies of its table row and no more.
    assert "Generate explode" in plan_of(salted) and "CartesianProduct" not in plan_of(salted)
    columns = ["id", "word", "value"]
    assert pairs(salted.select(columns)) == pairs(small.select(columns)) and salted.count() == 3000


def test_table_bytes_counts_values(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n long")
    assert table_bytes(df) == 2 + 2 * 8 + 2 * 32 and table_bytes(df.limit(0)) == 0


def test_translation_keeps_every_row(spark, texts):
    df = texts("美味しい", "美味しい", "まずい", "知らない", "plain", None, "")
    memory = spark.createDataFrame(
        [("美味しい", "delicious"), ("まずい", ""), ("plain", "never used")], "source_text string, translated string"
    )
    expected = [(0, "delicious"), (1, "delicious"), (2, "まずい"), (3, "知らない"), (4, "plain"), (5, None), (6, "")]
    for limit in (10**6, 0):
        assert pairs(X.translate_from_memory(df, memory, limit=limit)) == expected
    assert sorted(r[0] for r in X.missing_translations(df, memory).collect()) == ["まずい", "知らない"]
    assert {r.language: r.n for r in X.language_counts(df).collect()} == {"ja": 4, "en": 3}


def test_mixed_language(spark, texts):
    df = texts("a", "b", "c", None)
    overlay = spark.createDataFrame([(0, "日本"), (3, "四")], "review_id long, text string")
    assert pairs(X.mixed_language(df, overlay, 2, fallback="予備")) == [
        (0, "日本", "ja"), (1, "予備", "ja"), (2, "c", "en"), (3, None, "en"),
    ]
    sampled = X.mixed_language(df, overlay, 2, fallback="予備", sampled=True).collect()
    assert sorted(r.language for r in sampled) == ["en", "en", "ja", "ja"]
    assert pairs(X.overlay_sources(texts("x" * 400, "y"), "review_id", 1)) == [(0, "x" * 300)]


def test_lemmas_from_a_table(spark, texts):
    df = texts("Hops and  hops were THIN", "none", "", None, "beers " * 300)
    lemmas = {"hops": "hop", "were": "be", "beers": "beer"}
    table = spark.createDataFrame(list(lemmas.items()), "form string, lemma string")
    expected = pairs(df.select("review_id", F.coalesce(lemmatize_words(F.col("text"), lemmas), F.lit("")).alias("l")))
    for limit in (10**6, 0):
        got = lemmatize_with_table(df, table, "review_id", "text", "l", limit).select("review_id", "l")
        assert pairs(got) == expected


def test_replacement_keeps_rows_of_null_and_repeated_keys(spark):
    rows = [(1, "hops b"), (1, "malts c hops"), (None, "malts"), (None, "d"), (2, None), (3, "e f")]
    df = spark.createDataFrame(rows, "review_id long, text string")
    table = spark.createDataFrame([("hops", "hop"), ("malts", "malt")], "form string, lemma string")
    got = lemmatize_with_table(df, table, "review_id", "text", "l").select("review_id", "l")
    assert pairs(got) == sorted([(1, "hop b"), (1, "malt c hop"), (None, "malt"), (None, "d"), (2, ""), (3, "e f")], key=repr)


def test_only_hits_are_shuffled(spark):
    df = spark.range(2000).select(F.col("id").alias("review_id"), F.lit("plain words only here").alias("text"))
    df = df.unionByName(spark.createDataFrame([(5000, "hops")], "review_id long, text string"))
    table = spark.createDataFrame([("hops", "hop")], "form string, lemma string")
    plan = plan_of(lemmatize_with_table(df, table, "review_id", "text", "l"))
    exploded = plan[plan.index("Generate explode") - 2000 : plan.index("Generate explode")]
    # Between the words and their first exchange stands the look-up.
    assert "BroadcastHashJoin" in exploded and "isnotnull(replacement" in plan


def one_edit(a, b):
    letters = "abcdefghijklmnopqrstuvwxyz"
    cuts = [(a[:i], a[i:]) for i in range(len(a) + 1)]
    near = {l + r[1:] for l, r in cuts if r}
    near |= {l + c + r[1:] for l, r in cuts if r for c in letters}
    near |= {l + c + r for l, r in cuts for c in letters}
    near |= {l + r[1] + r[0] + r[2:] for l, r in cuts if len(r) > 1}
    return b in near


def test_corrections_against_brute_force(spark):
    rnd = random.Random(7)
    make = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randint(4, 6)))
    vocabulary = {make(): rnd.randint(20, 25) for _ in range(40)}
    words = {make() for _ in range(200)} | {"abcabcabcabc"}
    got = S.spell_corrections(
        spark.createDataFrame([(w,) for w in words], "word string"),
        spark.createDataFrame(list(vocabulary.items()), "word string, freq long"),
    )
    expected = {}
    for w in words - set(vocabulary):
        near = [v for v in vocabulary if one_edit(w, v)]
        if near:
            expected[w] = min(near, key=lambda v: (-vocabulary[v], v))
    assert dict(pairs(got)) == expected and len(expected) > 20
    plan = plan_of(got)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def edits_of(a, letters):
    cuts = [(a[:i], a[i:]) for i in range(len(a) + 1)]
    near = {l + r[1:] for l, r in cuts if r}
    near |= {l + c + r[1:] for l, r in cuts if r for c in letters}
    near |= {l + c + r for l, r in cuts for c in letters}
    return near | {l + r[1] + r[0] + r[2:] for l, r in cuts if len(r) > 1}


def test_two_edits_against_brute_force(spark):
    rnd = random.Random(11)
    make = lambda n: "".join(rnd.choice("abcd") for _ in range(n))
    vocabulary = {make(rnd.randint(4, 8)): rnd.randint(20, 25) for _ in range(40)}
    # Long words, on both sides of the length at which segments take over.
    vocabulary |= {make(n): 20 + n % 3 for n in range(12, 23) for _ in range(3)}
    words = {make(rnd.randint(4, 9)) for _ in range(150)}
    for word in list(vocabulary):
        for _ in range(3):
            for _ in range(rnd.randint(2, 3)):
                word = rnd.choice(sorted(edits_of(word, "abcd")))
            words |= {word} if len(word) >= 4 else set()
    words |= {"cadbadb", "abcd" * 40}
    got = S.spell_corrections(
        spark.createDataFrame([(w,) for w in words] + [(None,)], "word string"),
        spark.createDataFrame(list(vocabulary.items()), "word string, freq long"),
        edits=2,
    )
    expected, at_two = {}, 0
    for w in words - set(vocabulary):
        once = edits_of(w, "abcd") if len(w) < 40 else {w}
        near = once & set(vocabulary)
        if not near:
            near = set().union(*(edits_of(x, "abcd") for x in once)) & set(vocabulary)
            at_two += len(near) > 0
        if near:
            expected[w] = min(near, key=lambda v: (-vocabulary[v], v))
    assert dict(pairs(got)) == expected
    assert at_two > 50 and sum(len(w) > 15 for w in expected) > 10
    plan = plan_of(got)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_two_edits_with_nothing_in_the_tables(spark):
    words = spark.createDataFrame([("bitre",)], "word string")
    vocabulary = spark.createDataFrame([("bitter", 30)], "word string, freq long")
    assert pairs(S.spell_corrections(words, vocabulary, 2)) == [("bitre", "bitter")]
    assert pairs(S.spell_corrections(words, vocabulary)) == []
    assert pairs(S.spell_corrections(words.limit(0), vocabulary, 2)) == []
    assert pairs(S.spell_corrections(words, vocabulary.limit(0), 2)) == []


def test_correct_spelling_in_texts(spark, texts):
    vocabulary = spark.createDataFrame([("bitter", 30), ("creamy", 25)], "word string, freq long")
    df = texts("Bitterr bittre creamy cream creamyy! biter", None, "")
    got = S.correct_spelling(df, vocabulary, "review_id", "text", "fixed").select("review_id", "fixed")
    assert pairs(got) == [(0, "Bitterr bitter creamy creamy creamyy! bitter"), (1, ""), (2, "")]


def test_word_frequencies(texts):
    df = texts(*["Fine beer, FINE!"] * 3, "ale beer")
    assert pairs(S.word_frequencies(df, "text", 3)) == [("beer", 4), ("fine", 6)]


def test_words_are_listed_once_and_replaced_without_a_search_through_a_map(spark, texts):
    """explode had filtered by the size of the array, computed a second time; a map was searched for each word."""
    df = texts("Malty, malty maltt (hoppy)", "maltt ünter malty’s", "", None)
    listed = S.distinct_words(df, "text")
    assert "size(" not in plan_of(listed)
    assert sorted(r.word for r in listed.collect()) == ["hoppy", "maltt", "malty"]
    table = spark.createDataFrame([("maltt", "malty")], "form string, replacement string")
    got = replace_words(df, table, "review_id", "text", "out")
    assert "element_at" not in plan_of(got)
    assert [r.out for r in got.orderBy("review_id").collect()] == ["Malty, malty malty (hoppy)", "malty ünter malty’s", "", ""]


def test_keys_of_a_large_vocabulary_are_not_sent_through_the_driver(spark, monkeypatch, tmp_path):
    """Spark's estimate knows nothing of how many keys a word has, so it broadcast them all."""
    vocabulary = spark.range(2000).selectExpr("lpad(translate(CAST(id AS STRING), '0123456789', 'abcdefghij'), 9, 'k') AS word", "id AS freq")
    vocabulary.write.parquet(f"{tmp_path}/vocabulary")
    vocabulary = spark.read.parquet(f"{tmp_path}/vocabulary")
    words = vocabulary.selectExpr("concat('x', word) AS word").where("word LIKE '%a'")
    for edits in (1, 2):
        small = S.spell_corrections(words, vocabulary, edits)
        assert "SortMergeJoin" not in plan_of(small)
        with monkeypatch.context() as m:
            m.setattr(S, "KEY_BYTES", 1000)
            large = S.spell_corrections(words, vocabulary, edits)
            plan = plan_of(large)
            assert plan.count("SortMergeJoin [deletion_key") == plan.count("Generate explode") // 2 > 0
            assert sorted(map(tuple, large.collect())) == sorted(map(tuple, small.collect())) != []
