import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sipnote.llm import vector_codes as V
from sipnote.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows):
    """Exact integers, every entry looked at."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    parts = [[[int(np.floor(256 * x)) for x in p] for p in np.array_split(r[1], 16)] for r in kept]
    books = [[p[i] for p in parts[:64]] for i in range(16)]

    def assign():
        out = []
        for p in parts:
            row = []
            for i in range(16):
                distances = [sum((a - b) ** 2 for a, b in zip(p[i], c)) for c in books[i]]
                row.append((distances.index(min(distances)), min(distances)))
            out.append(row)
        return out

    for _ in range(2):
        found = assign()
        for i in range(16):
            for e in range(len(books[i])):
                own = [parts[k][i] for k in range(len(parts)) if found[k][i][0] == e]
                if own:
                    books[i][e] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    errors = [min(sum(d for _, d in f), 2**63 - 1) for f in found]
    totals = {}
    for r, e in zip(kept, errors):
        totals[r[2]] = totals.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    coded = [(r[0], r[2], bytes(e for e, _ in f), x, min(totals[r[2]], 2**63 - 1)) for r, f, x in zip(kept, found, errors)]
    return coded, digest


def check(df):
    coded, books = V.compress(df)
    got = [(r.vec_id, r.label, bytes(r.code), r.error, r.label_error) for r in coded.collect()]
    wanted, digest = brute_force([(r.vec_id, r.embedding, r.label) for r in df.select("vec_id", "embedding", "label").collect()])
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert V.codebooks_digest(books) == digest
    return coded, books


def test_whole_table(spark, sf):
    check(table(spark, sf, "embeddings").limit(200))


def test_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 32) / 128], i % 3 or None) for i in range(90)]
    rows += [(i, list(rows[0][1]), 7) for i in range(90, 130)] + [rows[5], rows[5], (5, rows[6][1], 1), (None, rows[8][1], 2)]
    rows += [(200, None, 1), (201, [None] * 32, 1), (202, [float("nan")] * 32, 1), (203, [float("-inf")] * 32, 1)]
    rows += [(204, [1e30] * 32, 9), (205, [-1e9] * 32, None), (206, [1e6] * 32, 3)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS error", "3 AS part", "4 AS _label")
    wanted = [(a, None if v is None else [None if x is None else max(-(2.0**54), min(2.0**54, x)) if np.isfinite(x) else x for x in v], c) for a, v, c in rows]
    coded, books = V.compress(df)
    got = [(r.vec_id, r.label, bytes(r.code), r.error, r.label_error) for r in coded.collect()]
    exact, digest = brute_force(wanted)
    assert sorted(map(repr, got)) == sorted(map(repr, exact)) and V.codebooks_digest(books) == digest


def test_few_and_none(spark):
    few = spark.createDataFrame([(3, [0.5] * 20, 1), (1, [0.25] * 20, None), (2, [0.1] * 3, 1)], SCHEMA)
    coded, books = V.compress(few)
    assert {(r.vec_id, r.error, r.label_error) for r in coded.collect()} == {(1, 0, 0), (3, 0, 0)}
    assert [b.shape for b in books] == [(2, 2)] * 4 + [(2, 1)] * 12
    for rows in ([], [(1, None, 2)], [(1, [], 2)]):
        coded, books = V.compress(spark.createDataFrame(rows, SCHEMA))
        assert coded.count() == len([r for r in rows if r[1] is not None])


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 5), st.integers(1, 40), st.integers(0, 10**6), st.integers(1, 30))
def test_search_is_exact(d, entries, seed, spread):
    rng = np.random.default_rng(seed)
    book, parts = rng.integers(-spread, spread + 1, (entries, d)), rng.integers(-spread, spread + 1, (60, d))
    index, best, _ = V.Book(book).nearest(parts)
    distances = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (index == distances.argmin(axis=1)).all() and (best == distances.min(axis=1)).all()
    large = (parts.astype(object) * 2**50, book.astype(object) * 2**50)
    again, far, _ = V.Book(large[1]).nearest(large[0])
    assert (again == index).all() and (far == best.astype(object) * 2**100).all()


def test_search_looks_at_few():
    rng = np.random.default_rng(5)
    book, parts = rng.normal(0, 32, (64, 4)).astype(int), rng.normal(0, 32, (4000, 4)).astype(int)
    _, _, looked = V.Book(book).nearest(parts)
    assert looked < 0.6 * 64 * 4000


def test_codes_stand_for_vectors(spark, sf):
    rows = table(spark, sf, "embeddings")
    coded, books = V.compress(rows)
    codes = {r.vec_id: (bytes(r.code), r.error) for r in coded.collect()}
    for r in rows.limit(50).collect():
        code, error = codes[r.vec_id]
        back = V.decode(np.frombuffer(code, np.uint8)[None], books)[0]
        assert ((np.floor(256 * np.array(r.embedding)) - back) ** 2).sum() == error
