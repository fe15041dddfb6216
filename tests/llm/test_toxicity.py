import random
import time
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sipnote.llm import toxicity as T
from tests.llm.helpers import docs_of


def maximal_segments(scores):
    """The best segment, and those left and right of it in turn (Ruzzo and Tompa's definition)."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            x = sum(scores[i:j])
            if x > 1e-9 and (best is None or x > best[2] + 1e-9):
                best = (i, j, x)
    if best is None:
        return []
    i, j, x = best
    right = [(a + j, b + j, s) for a, b, s in maximal_segments(scores[j:])]
    return maximal_segments(scores[:i]) + [best] + right


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 1.0, 2.5, 4.25]), max_size=14))
def test_segments_are_the_maximal_ones(values):
    drift = 0.375 * 2
    scores = [v if v else -drift for v in values]
    got = T.segments([(i, v) for i, v in enumerate(values) if v], drift)
    wanted = maximal_segments(scores)
    assert sorted(round(s, 6) for _, _, s in got) == sorted(round(s, 6) for _, _, s in wanted)
    assert all(abs(sum(scores[a:b]) - s) < 1e-9 for a, b, s in got)


def corpus(n=1200):
    rng = random.Random(5)
    plain = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]
    bad = ["vilified", "scoundrel", "wretchlike", "wretchy"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, 120))
        toxic = i % 7 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_and_edges(spark):
    docs, labels = corpus()
    more = [(5000, None), (5001, ""), (None, "a scoundrel vilified"), (5002, "a b c"), (5002, "a b c")]
    more += [(5003, "wretchlings of a scoundrel " * 20_000), (5004, "😀 123 --")]
    table = docs_of(spark, *docs, *more).withColumnRenamed("lang", "toxic").withColumnRenamed("source", "fold")
    known = spark.createDataFrame([*labels, (0, 1, 0), (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    out = T.toxicity(table, known).collect()
    assert len(out) == len(docs) + len(more)
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    by = {r.doc_id: r for r in out}
    assert by[None].predicted == 1 and not by[None].held_out and by[5003].predicted == 1
    assert by[5000].score == by[5001].score < 0.5 and by[5000].passages == []
    first = [p for p in by[5003].passages]
    assert first and all(p.end > p.start for p in first)


def test_scores_ignore_what_is_not_text(spark):
    docs, labels = corpus(400)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.fit(docs_of(spark, *docs), known)
    same = docs_of(spark, (1, docs[0][1], "en"), (2, docs[0][1], "fr"))
    assert same.count() == 2 and T.score_texts(same, model).select("score").distinct().count() == 1


def test_nothing_to_learn_from(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, (1, "one"), (2, "two"))
    assert T.toxicity(docs, labels).select("score").distinct().count() == 1
    assert T.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_held_out_labels_are_not_used(spark):
    docs, labels = corpus(400)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    flipped = known.withColumn("toxic", F.when(T._fold("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (T.fit(docs_of(spark, *docs), k) for k in (known, flipped))
    assert one.weights == two.weights and abs(one.level - two.level) < 1e-9


def test_extreme_values(spark):
    model = T.Model({"x": 3.0})
    T.fit_extremes(model, [(10_000, [(0, 1, 3.0)])] * 5, T.Counter({3.0: 5}))
    n = 50_001
    p = 6 / n
    assert abs(p * np.exp(3 * model.rate) + (1 - p) * np.exp(-model.drift * model.rate) - 1) < 1e-3
    assert model.evidence(100, [(0, 1, 3.0)]) and not model.evidence(10**9, [(0, 1, 3.0)])


def plain_segments(hits, drift):
    """The same by looking back one segment at a time."""
    found, total, last = [], 0.0, 0
    for at, score in hits:
        total -= drift * (at - last)
        new, total, last = [at, at + 1, total, total + score], total + score, at + 1
        while True:
            j = max((k for k in range(len(found)) if found[k][2] < new[2]), default=-1)
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(s, e, r - l) for s, e, l, r in found]


def test_segments_of_very_many_hits():
    rng = np.random.default_rng(4)
    for step in (1, 3, 40):
        places = np.cumsum(rng.integers(1, 1 + step, 400)).tolist()
        hits = [(p, float(s)) for p, s in zip(places, rng.integers(1, 9, 400) / 2)]
        assert T.segments(hits, 0.5) == plain_segments(hits, 0.5)
    start = time.perf_counter()
    apart = T.segments([(60 * i, 1.0) for i in range(100_000)], 0.5)
    assert len(apart) == 100_000 and time.perf_counter() - start < 5
