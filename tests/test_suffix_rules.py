import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sipnote.functions.word_tables import LEMMAS
from sipnote.operators import suffix_rules as S


def plain_rules(lemmas):
    pairs = {**{v: v for v in lemmas.values()}, **lemmas}
    counts = defaultdict(Counter)
    for form, lemma in pairs.items():
        for k in range(1, min(5, len(form) - 2) + 1):
            stem = form[:-k]
            counts[form[-k:]][lemma[len(stem) :] if lemma.startswith(stem) else None] += 1
    rules = {}
    for suffix, found in counts.items():
        known = sorted((-n, r) for r, n in found.items() if r is not None)
        if known and -known[0][0] >= 2 and -known[0][0] * 100 >= 60 * sum(found.values()):
            rules[suffix] = known[0][1]
    return rules


def plain_lemma(word, rules):
    for k in range(min(5, len(word) - 2), 0, -1):
        if re.fullmatch("[a-z]{3,}", word) and word[-k:] in rules:
            return word[:-k] + rules[word[-k:]]
    return word


def table(spark, lemmas):
    return spark.createDataFrame(list(lemmas.items()), "form string, lemma string")


@pytest.mark.parametrize("fold", range(4))
def test_held_out_pairs(spark, fold):
    items = sorted((f, l) for f, l in LEMMAS.items() if len(f) >= 3 and f[:2] == l[:2])
    train = dict(p for i, p in enumerate(items) if i % 4 != fold)
    held = dict(p for i, p in enumerate(items) if i % 4 == fold)
    lemmas = table(spark, train)
    rules = S.suffix_rules(lemmas)
    assert {r.suffix: r.replacement for r in rules.collect()} == plain_rules(train)
    words = table(spark, held).select(F.col("form").alias("word"))
    got = {r.word: r.lemma for r in S.ruled_lemmas(words, lemmas, rules).collect()}
    unknown = [w for w in held if w not in train.values()]
    assert {w: got.get(w, w) for w in unknown} == {w: plain_lemma(w, plain_rules(train)) for w in unknown}
    right = sum(got.get(w, w) == held[w] for w in unknown)
    # Left alone, none of them is right.
    assert right >= 0.5 * len(unknown), f"{right} of {len(unknown)}"


def test_texts(spark):
    lemmas = table(spark, {"hops": "hop", "malts": "malt", "was": "be", "poured": "pour", "labeled": "label"})
    rows = [(1, "Hops WIDGETS was  kettled"), (1, "x-rays ties as 日本s"), (None, "widgets"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "k long, t string").withColumn("word", F.lit("own"))
    done = S.lemmatize_with_rules(df, lemmas, "k", "t", "l")
    assert done.columns == ["k", "t", "word", "l"]
    got = sorted((tuple(r) for r in done.select("k", "l").collect()), key=repr)
    assert got == sorted([(1, "hop widget be kettl"), (1, "x-rays tie as 日本s"), (None, "widget"), (2, ""), (3, "")], key=repr)
    assert S.lemmatize_with_rules(df, lemmas.limit(0), "k", "t", "l").where("t = 'widgets'").first().l == "widgets"
    assert S.lemmatize_with_rules(df.limit(0), lemmas, "k", "t", "l").count() == 0
