import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sipnote.llm import jaccard_join as J
from sipnote.llm.common import table
from sipnote.llm.graph import components
from tests.llm.helpers import component_ids, docs_of, shingles


def check(docs, words=3, percent=90):
    rows = docs.select("doc_id", "text").collect()
    sets = {r.doc_id: shingles(r.text, words) for r in rows if r.doc_id is not None}
    wanted = component_ids(sets, percent)
    got = J.linked_documents(docs, words, percent).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), wanted[r.doc_id])
    return wanted


def family(rng, n, length, edits):
    """Copies of one text, each with a few words replaced."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def mixed_docs(seed=1):
    rng = random.Random(seed)
    texts = []
    for length, edits in ((4, 1), (9, 1), (12, 1), (15, 1), (20, 1), (30, 2), (60, 3), (150, 6), (400, 14)):
        texts += family(rng, 12, length, edits)
        base = family(rng, 1, length, 0)[0]
        texts += [base + f" more{i}" for i in range(3)] + [f"less{i} " + base for i in range(2)]
    shared = " ".join(f"s{i}" for i in range(30))
    texts += [f"{shared} " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.randint(0, 8))) for _ in range(40)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_all_sizes(spark):
    wanted = check(docs_of(spark, *mixed_docs()))
    assert 20 < len(wanted) - len(set(wanted.values())) < len(wanted) - 20


def test_five_words_and_80_percent(spark):
    check(docs_of(spark, *mixed_docs(2)), 5, 80)


@pytest.mark.parametrize("heavy", [1, 18, 36])
def test_any_boundary_gives_the_same(spark, monkeypatch, heavy):
    monkeypatch.setattr(J, "boundary", lambda *_: heavy)
    check(docs_of(spark, *[(i, t) for i, t in mixed_docs(3) if len(t.split()) < 100]))


def test_long_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 16)
    rng = random.Random(4)
    texts = family(rng, 300, 50, 4) + family(rng, 60, 80, 3)
    check(docs_of(spark, *enumerate(texts)))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "one two"), (7, "ONE\x0btwo"), (8, "a b c")]
    rows += [(9, "a b c a b c a b c"), (None, "a b c"), (None, "n u l l"), (10, "É a b"), (11, "é a b")]
    rows += [(12, "v " * 50_000), (13, "v v v v"), (14, "x y z w"), (15, "x y z w")]
    rows += [(i, "hot copy of the same text " * 3) for i in range(100, 180)]
    long = " ".join(f"t{i}" for i in range(6000))
    rows += [(200, long), (201, long + " end"), (202, long.replace("t5 ", "u5 "))]
    docs = docs_of(spark, *rows)
    wanted = check(docs)
    assert wanted[150] == 100 and wanted[202] == 200 and wanted[2] == 2 and wanted[7] == 6 and wanted[13] == 12
    check(docs.withColumnRenamed("lang", "set_id").withColumnRenamed("source", "n"))
    nulls = [r for r in J.linked_documents(docs).collect() if r.doc_id is None]
    assert len(nulls) == 2 and all(r.component_id is None for r in nulls)
    assert J.linked_documents(docs.limit(0)).count() == 0


def test_repeated_ids(spark):
    out = J.linked_documents(docs_of(spark, (1, "a b c d"), (1, "e f g h"), (2, "E F G H"), (3, "z z z")))
    assert sorted((r.doc_id, r.component_id) for r in out.collect()) == [(1, 1), (1, 1), (2, 1), (3, 3)]


def test_null_id_is_the_smallest_of_small_sets(spark, monkeypatch):
    monkeypatch.setattr(J, "boundary", lambda *_: 36)
    rows = []
    for k in range(3):
        base = " ".join(f"b{k}x{i}" for i in range(20))
        near = [base] if k == 0 else [f"{base} n{i}" for i in range(9)]
        rows += [(10 * k + 1, base + " a"), (10 * k + 2, base + " b"), *[(None, t) for t in near]]
    wanted = check(docs_of(spark, *rows))
    assert wanted == {1: 1, 2: 1, 11: 11, 12: 11, 21: 21, 22: 21}


def test_one_row_of_each_component_of_repeated_ids(spark):
    rng = random.Random(6)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(7)]
    near = lambda k, i: f"{base[k]} end{i}"
    rows = [(5, base[0]), (9, near(0, 1)), (3, base[1]), (5, near(1, 1))]  # 5 stays for one text, goes for another
    rows += [(11, base[2]), (11, near(2, 1)), (12, near(2, 2))]  # both rows of the smallest id in one component
    rows += [(20, base[3]), (20, base[4]), (15, near(3, 1)), (16, near(4, 1))]  # one id must not join two components
    rows += [(30, base[5]), (30, base[5].upper()), (31, near(5, 1))]  # one id, one set
    rows += [(40, None), (40, " "), (40, base[6]), (None, near(6, 1)), (None, near(6, 1)), (50, "x y z")]
    docs = docs_of(spark, *rows)
    left = J.without_near_copies(docs.withColumnRenamed("lang", "set_id").withColumnRenamed("source", "row"), 5, 80)
    assert left.columns == ["doc_id", "text", "set_id", "row", "n_chars"]
    out = sorted((str(r.doc_id), str(r.text)) for r in left.collect())
    eleven = [t for i, t in out if i == "11"]
    assert len(eleven) == 1 and eleven[0] in (base[2], near(2, 1))
    kept = [(5, base[0]), (3, base[1]), (11, eleven[0]), (15, near(3, 1)), (16, near(4, 1)), (30, base[5].upper())]
    kept += [r for r in rows if r[0] in (None, 40, 50)]
    assert out == sorted((str(i), str(t)) for i, t in kept)
    assert J.without_near_copies(docs.limit(0), 5, 80).count() == 0


def test_a_repeated_id_joins_no_components(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = docs_of(spark, (5, one), (5, two), (2, one + " end"), (3, two + " end"), (7, "p q r s"))
    out = sorted((r.doc_id, r.component_id) for r in J.linked_documents(docs).collect())
    assert out == [(2, 2), (3, 3), (5, 2), (5, 3), (7, 7)]


def test_given_documents(spark, sf):
    check(table(spark, sf, "documents"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbB \t\né"), max_size=30), min_size=1, max_size=6))
def test_shingle_hashes(texts):
    got = J.shingle_sets(texts)
    names = {}
    for t, hashes in zip(texts, got):
        own = shingles(t)
        assert len(own) == len(hashes) and np.all(hashes[1:] > hashes[:-1])
        names.setdefault(own, hashes.tobytes())
        assert names[own] == hashes.tobytes()
    assert len(set(names.values())) == len(names)


def test_needed_is_the_contract():
    for percent in (80, 90):
        for a in range(1, 60):
            for b in range(a, 70):
                least = J.needed(a, b, percent)
                assert 100 * least >= percent * (a + b - least)
                assert 100 * (least - 1) < percent * (a + b - least + 1)
                if least <= a:
                    assert a >= J.smallest_partner(b, percent) and least in J.subset_sizes(a, percent)


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 90)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    best = {x: x for e in links for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(best[a], best[b])
            changed |= best[a] != low or best[b] != low
            best[a] = best[b] = low
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: c for x, c in best.items() if x in linked}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingle_family(kind, size, words, rng):
    """Shingle sets of near copies: of one text, or each of the one before."""
    base = [f"w{i}" for i in range(words)]
    texts = []
    for _ in range(size):
        own = list(base)
        for _ in range(3):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
        if kind == "chain":
            base = own
    return J.shingle_sets(texts, 3)


@pytest.mark.parametrize("kind", ["cloud", "chain"])
@pytest.mark.parametrize("words", [60, 200])
def test_rows_of_a_list_grow_with_its_sets(kind, words):
    """Scans of one list with a whole family: at most two rows a set, and in the end every component."""
    for size in (250, 500, 1000):
        sets = shingle_family(kind, size, words, random.Random(size + words))
        n = [len(s) for s in sets]
        maps = [J.bitmaps(s) for s in sets]
        label = list(range(size))

        def scan(run, more=()):
            columns = [pa.array([7] * size, pa.int64()), pa.array(range(size), pa.int64()), pa.array(n, pa.int64())]
            columns += [pa.array([1] * size, pa.int64()), pa.array(label, pa.int64())]
            columns += [pa.array([m[k] for m in maps], pa.binary()) for k in (0, 1)] + list(more)
            batch = pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])
            return [tuple(r.values()) for b in run(iter([batch])) for r in b.to_pylist()]

        def join(pairs):
            for a, b in pairs:
                if label[a] != label[b]:
                    old, new = max(label[a], label[b]), min(label[a], label[b])
                    label[:] = [new if x == old else x for x in label]

        def linked(a, b):
            shared = len(np.intersect1d(sets[a], sets[b]))
            return 100 * shared >= 90 * (n[a] + n[b] - shared)

        for _ in range(2):
            rows = scan(J.Scan(90).run)
            assert len(rows) <= 2 * size
            join((a, b) for _, a, b in rows if linked(a, b))
        rest = scan(J.Settle(90).run, [pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))])
        assert len(rest) < size and all(linked(a, b) for a, b in rest)
        join(rest)
        if size < 1000:
            wanted = component_ids({i: frozenset(s.tolist()) for i, s in enumerate(sets)}, 90)
            assert dict(enumerate(label)) == wanted


def test_entries_of_long_lists_grow_with_their_sets(spark, monkeypatch):
    """A family in one list, joined but for a few sets: its blocks are not dealt to pairs, and no pair is missed."""
    monkeypatch.setattr(J, "BLOCK", 16)
    lister = J.Lister(3, 90, 1, np.full(J.COUNTERS, 9, np.uint8))
    (own,) = J.shingle_sets([" ".join(f"w{i}" for i in range(102))])
    (batch,) = lister.run(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [" ".join(f"w{i}" for i in range(102))]})]))
    assert len(batch) == len(own) - J.smallest_partner(len(own), 90) + J.SHARED

    for joined, most in ((640, 640 + 7 * 40), (0, None)):
        label = {i: 0 if i < joined else i for i in range(647)}
        by_set = spark.createDataFrame([([7, 8], i) for i in label], "keys array<long>, set_id long")
        labels = spark.createDataFrame([(i, 0) for i in range(joined)], "set_id long, label long")
        entries = J._labelled(by_set, labels).select(J.F.explode("keys").alias("key"), "set_id", "label")
        dealt = J._met_blocks(entries, J.open_lists(by_set, labels)).collect()
        met, lists = set(), {}
        for r in dealt:
            lists.setdefault(r.key, []).append(r.set_id)
        for sets in lists.values():
            met |= {(a, b) for a in sets for b in sets if label[a] < label[b]}
        assert met == {(a, b) for a in label for b in label if label[a] < label[b]}
        assert most is None or len(dealt) <= 2 * most
    closed = spark.createDataFrame([(i, 0) for i in label], "set_id long, label long")
    assert J.open_lists(by_set, closed).isEmpty()
