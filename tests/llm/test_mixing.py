import random

import numpy as np
from pyspark.sql import functions as F

from sipnote.llm import mixing as M
from tests.conftest import plan_of
from tests.llm.helpers import docs_of

TARGETS = {"en": 0.25, "fr": 0.5, "de": 0.25}


def corpus(n=600):
    rng = random.Random(6)
    stems = {"en": ["the", "stone", "of", "river"], "fr": ["le", "pierre", "du", "fleuve"], "de": ["der", "stein", "am", "fluss"]}
    out = []
    for i in range(n):
        lang = rng.choices(list(stems), weights=[6, 2, 2])[0]
        out.append((i, " ".join(rng.choices(stems[lang], k=rng.randint(5, 60))), lang))
    return out


def labelled(docs):
    return docs.where("doc_id % 2 = 0").select("doc_id", F.col("lang").alias("domain"))


def expected_totals(rows, k):
    p = np.array([r.p for r in rows])
    return (p * np.array([r.tokens * r.rate for r in rows])[:, None]).sum(axis=0)


def test_totals_meet_targets(spark):
    docs = docs_of(spark, *corpus())
    for total, least in ((None, 1.0), (None, 0.0), (9_000.0, 0.0)):
        mixed, report = M.mix(docs, labelled(docs), TARGETS, total=total, least=least)
        rows = mixed.collect()
        want = np.array([TARGETS[d] for d in report["domains"]]) * (total or sum(report["target"]))
        got = expected_totals(rows, 3)
        assert np.allclose(got, want, rtol=2e-3) and np.allclose(got, report["reached"], rtol=1e-6)
        assert all(r.rate >= least and abs(r.copies - r.rate) < 1 and abs(sum(r.p) - 1) < 1e-9 for r in rows)
        copied = sum(r.copies * r.tokens for r in rows)
        assert abs(copied / sum(want) - 1) < 0.1


def test_posteriors_name_the_language(spark):
    docs = docs_of(spark, *corpus())
    mixed, report = M.mix(docs, labelled(docs), TARGETS, ["doc_id", "lang"])
    right = [report["domains"][int(np.argmax(r.p))] == r.document.lang for r in mixed.collect()]
    assert np.mean(right) > 0.99


def test_projection_is_active_and_optimal(spark):
    # Far fewer English tokens than there are: without the bound their rates would go below it.
    docs = docs_of(spark, *corpus(200))
    mixed, report = M.mix(docs, labelled(docs), {"en": 0.1, "fr": 0.5, "de": 0.4}, total=3_000.0, least=0.5)
    rows = mixed.collect()
    en, fr = (report["domains"].index(d) for d in ("en", "fr"))
    assert min(r.rate for r in rows) == 0.5 and report["steps"] > 0
    assert all(r.rate == 0.5 for r in rows if r.p[en] > 0.9999)
    assert abs(expected_totals(rows, 3)[fr] - 1_500) < 15


def test_native(spark):
    docs = docs_of(spark, *corpus(50))
    mixed, _ = M.mix(docs, labelled(docs), TARGETS)
    assert "Python" not in plan_of(mixed) and "Arrow" not in plan_of(mixed)


def test_edges(spark):
    rows = [*corpus(80), (1000, None), (1001, ""), (None, "the stone"), (5, "le pierre le"), (1002, "der " * 50_000)]
    docs = docs_of(spark, *rows).withColumnRenamed("source", "rate").withColumnRenamed("n_chars", "copies")
    known = labelled(docs).unionByName(spark.createDataFrame([(None, "en"), (2, None), (4, "xx"), (4, "en")], "doc_id long, domain string"))
    mixed, _ = M.mix(docs, known, TARGETS, docs.columns)
    out = mixed.collect()
    assert len(out) == len(rows) and {r.document.doc_id for r in out} >= {1000, 1001, None}
    assert {r.tokens for r in out if r.document.doc_id in (1000, 1001)} == {0}
    assert next(r.tokens for r in out if r.document.doc_id == 1002) == 50_000
    nothing, report = M.mix(docs, known.limit(0), TARGETS)
    assert {(r.rate, r.copies) for r in nothing.collect()} == {(1.0, 1)} and report["domains"] == []
    assert M.mix(docs.limit(0), known, TARGETS)[0].count() == 0
