import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sipnote.llm import quality as Q
from sipnote.llm.common import table
from tests.llm.helpers import DOCS, docs_of


def plain_model(texts, order):
    """The same model from dictionaries: a function (context, byte) -> probability."""
    counts = {order: Counter()}
    for t in texts:
        data = b"\0" * (order - 1) + t.encode() + b"\0"
        counts[order].update(data[i : i + order] for i in range(len(data) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    marks = {k: Q.discounts(*[sum(n == i for n in c.values()) for i in (1, 2, 3, 4)]) for k, c in counts.items()}
    contexts = {}
    for k, c in counts.items():
        for g, n in c.items():
            total, free = contexts.get((k, g[:-1]), (0, 0.0))
            contexts[k, g[:-1]] = (total + n, free + marks[k][min(n, 3) - 1])

    def p(g):
        k = len(g)
        if not k:
            return 1 / 256
        lower = p(g[1:])
        if (k, g[:-1]) not in contexts:
            return lower
        total, free = contexts[k, g[:-1]]
        n = counts[k].get(g, 0)
        return (n - (marks[k][min(n, 3) - 1] if n else 0)) / total + free / total * lower

    return p


TEXTS = ["the cat sat on the mat", "the dog sat on the log", "über den Fluß", "a cat and a dog", "the the the"]


@pytest.mark.parametrize("order", [3, 5])
def test_model_against_dictionaries(spark, order):
    p = plain_model(TEXTS, order)
    assert abs(sum(p(b"the "[-order + 1 :] + bytes([b])) for b in range(256)) - 1) < 1e-9
    counts = Q.count_ngrams(docs_of(spark, *enumerate(TEXTS)).select("text"), order)
    model = Q.estimate(counts, order)
    new = ["the cat", "Xyz \x01 the mat über", "", "q" * 50, "the dog and the cat sat on the Fluß"]
    docs = docs_of(spark, *enumerate(new))
    for entries in (10**6, 40):
        assert len(Q.model_shards(model, order, entries)) > 1 or entries > 40
        scored, nats, size = Q.score(docs, model, ["doc_id"], order, entries)
        got = {r.doc_id: (r[nats], r[size]) for r in scored.collect()}
        for i, t in enumerate(new):
            data = b"\0" * (order - 1) + t.encode() + b"\0"
            logs = [math.log(p(data[j : j + order])) for j in range(len(data) - order + 1)]
            assert got[i][1] == len(t.encode())
            assert abs(got[i][0] + sum(logs) / len(logs)) < 1e-4


def test_hash_table():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**60, 5000, dtype=np.uint64))
    values = rng.standard_normal(len(keys)).astype(np.float32)
    held = Q.Table(keys[:4000], values[:4000])
    got, found = held.find(keys)
    assert found[:4000].all() and not found[4000:].any()
    assert np.array_equal(got[:4000], values[:4000]) and not got[4000:].any()


def corpus(n=900):
    rng = random.Random(8)
    out = []
    for i in range(n):
        lang = "en" if i % 3 else "fr"
        stem = ["stone", "river", "cloud", "light"] if lang == "en" else ["pierre", "fleuve", "nuage", "jour"]
        text = " ".join(rng.choices(stem, k=rng.randint(30, 60)))
        bad = i % 10 == 0
        out.append((i, "".join(rng.choices("zqxj#$%", k=len(text))) if bad else text, lang, bad))
    return out


def test_rejects_junk_and_edges(spark):
    made = corpus()
    rows = [(i, t, lang, "s", len(t)) for i, t, lang, _ in made]
    rows += [(5000, None, "en", "s", 0), (5001, "", None, "s", 0), (None, "river stone cloud light " * 9, None, None, None)]
    rows += [(5002, "qzx#" * 40_000, "xx", "s", 1), (3, "stone river " * 20, "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("source", "kept").withColumnRenamed("n_chars", "threshold")
    labels = [(i, int(not bad), 0) for i, _, _, bad in made if i % 2]
    labels = spark.createDataFrame([*labels, (1, 1, 0), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    judged, names = Q.classify(docs, labels)
    out = judged.collect()
    assert judged.columns == [*docs.columns, *names] and len(set(judged.columns)) == 8 and len(out) == len(rows)
    kept = {}
    for r in out:
        kept.setdefault(r.doc_id, []).append(r[names[2]])
    for i, _, _, bad in made:
        if not bad:
            assert all(kept[i])
    assert sum(kept[i][0] for i, _, _, bad in made if bad) == 0
    assert kept[5000] == kept[5001] == kept[None] == [True]
    assert len(kept[3]) == 2
    few, (_, _, keep) = Q.classify(docs, labels.limit(0))
    assert few.where(F.col(keep)).count() == len(rows)
    assert Q.classify(docs.limit(0), labels)[0].count() == 0


def test_bands_of_few_trusted_documents(spark):
    rng = random.Random(5)
    good = lambda n: " ".join(rng.choices(["stone", "river", "cloud", "light"], k=n))
    junk = lambda n: "".join(rng.choices("zqxj#$%", k=n))
    sizes = [3] * 5 + [60] * 120 + [4000] * 5
    rows = [(i, good(n), "en" if i % 2 else "fr") for i, n in enumerate(sizes)]
    rows += [(1000, junk(20)), (1001, junk(30_000)), (1002, junk(300_000), None), (1003, junk(300)), (1004, junk(2))]
    rows += [(2000, good(3000)), (2001, good(60))]
    docs = docs_of(spark, *rows)
    # Enough trusted documents in one band, and too few in all.
    for ids in (range(len(sizes)), range(0, len(sizes), 5)):
        labels = spark.createDataFrame([(i, 1, 0) for i in ids], "doc_id long, quality int, toxic int")
        judged, (_, limit, kept) = Q.classify(docs, labels)
        out = {r.doc_id: r for r in judged.collect()}
        assert all(r[limit] is not None for r in out.values())
        assert not any(out[i][kept] for i in range(1000, 1005))
        assert all(out[i][kept] for i in [*ids, 2000, 2001])


def test_bands_around():
    assert Q.wider({b: 100 for b in range(Q.BANDS)}) == {}
    around = Q.wider({2: 60, 3: 60, 4: 900, 7: 10})
    assert around[2] == (1, 3) and around[3] == (2, 4) and around[7] == (4, 10) and around[0] == (-3, 3) and 4 not in around
    few = Q.wider({4: 1, 9: 1})
    assert set(few) == set(range(Q.BANDS)) and all(a <= 4 and b >= 9 for a, b in few.values())


def test_given_documents(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    judged, (_, _, kept) = Q.classify(docs, labels, ["doc_id", "lang"])
    good = judged.join(labels, "doc_id").where("quality = 1")
    assert good.where(~F.col(kept)).count() == 0
