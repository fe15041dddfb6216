import corpus_pipeline
from sipnote.llm import mixing, quality
from sipnote.llm.common import table
from sipnote.session import written
from tests.llm.helpers import component_ids, lower_ascii, shingles
from tests.llm.test_packing import ids_of


def test_stages_against_plain_versions(spark, sf):
    docs = table(spark, sf, "documents")
    columns, left = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        left.append(written(stage(spark, left[-1], sf), f"test-{name}"))
    before, good, exact, near, mixed, packed = left
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert all(d.columns == columns for d in left[:-1])

    judged, (_, _, kept) = quality.classify(before, table(spark, sf, "labels"))
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in judged.where(kept).collect()}

    texts = {r.doc_id: r.text for r in good.collect()}
    largest = {}
    for i, t in texts.items():
        largest[lower_ascii(t)] = max(i, largest.get(lower_ascii(t), -1))
    assert sorted(r.doc_id for r in exact.collect()) == sorted(largest.values())

    sets = {r.doc_id: shingles(r.text, 5) for r in exact.collect()}
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(component_ids(sets, 80).values()))

    known = mixing.labelled_languages(near, table(spark, sf, "labels"))
    rates, _ = mixing.mix(near, known, corpus_pipeline.LANGUAGE_TARGETS, least=1.0)
    wanted = sorted(r.document.doc_id for r in rates.collect() for _ in range(r.copies))
    assert sorted(r.doc_id for r in mixed.collect()) == wanted and set(wanted) == {r.doc_id for r in near.collect()}

    tokens = sum(len(ids_of(r.text)) for r in mixed.collect())
    pieces = packed.collect()
    assert sum(r.length for r in pieces) == tokens
    assert len({r.sequence_id for r in pieces}) <= 1.05 * (-(-tokens // 2048)) + 1


def test_run_and_empty(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns[:2] == ["doc_id", "piece"] and out.count() > 0
    docs = table(spark, sf, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), f"test-empty-{name}")
        assert docs.count() == 0
