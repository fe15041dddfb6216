import os

import numpy as np
import pytest

from sipnote.llm import vector_join as J
from sipnote.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, least=0.9):
    """(vec_id, n_links, component_id) per row, from all pairs of rows (vec_id, vector)."""
    n = len(rows)
    usable = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    counts, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_size = {}
    for i in usable:
        by_size.setdefault(len(rows[i][1]), []).append(i)
    for own in by_size.values():
        x = np.array([rows[i][1] for i in own], dtype=np.float64)
        x = x * 2.0 ** -np.floor(np.log2(np.abs(x).max(axis=1, keepdims=True)))
        inner, length = x @ x.T, np.sqrt((x * x).sum(axis=1))
        linked = inner / np.outer(length, length) >= least
        for a, b in zip(*np.nonzero(np.triu(linked, 1))):
            i, j = own[a], own[b]
            counts[i] += 1
            counts[j] += 1
            root[find(j)] = find(i)
    least_of = {}
    for i in usable:
        r = find(i)
        least_of[r] = min(least_of.get(r, rows[i][0]), rows[i][0])
    return sorted(repr((k, counts[i], least_of.get(find(i), k) if i in set(usable) else k)) for i, (k, _) in enumerate(rows))


def check(df, least=0.9, **options):
    out = J.linked_vectors(df, least, **options).collect()
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    assert sorted(repr((r.vec_id, r.n_links, r.component_id)) for r in out) == brute_force(rows, least)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return out


def families(seed, sizes, d=64, noise=0.3):
    rng = np.random.default_rng(seed)
    out = []
    for size in sizes:
        middle = rng.standard_normal(d)
        out += [middle + noise * rng.standard_normal(d) * rng.random() * (size > 1) for _ in range(size)]
    return [[float(np.float32(x)) for x in v] for v in out]


def frame(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], schema)


def test_whole_table(spark, sf):
    check(table(spark, sf, "embeddings"))


@pytest.mark.parametrize("tile_bytes", [J.TILE_BYTES, 64 * 256])
def test_families_over_many_tiles(spark, tile_bytes):
    vectors = families(1, [1] * 150 + [2] * 60 + [30, 200])
    out = check(frame(spark, vectors), tile_bytes=tile_bytes)
    assert max(r.n_links for r in out) > 100


def test_chains_near_the_threshold(spark):
    rng = np.random.default_rng(2)
    plane, _ = np.linalg.qr(rng.standard_normal((24, 2)))
    angles = np.cumsum(np.arccos(0.9) + rng.choice([-1e-3, 1e-4, -1e-5], 120))
    vectors = [[float(x) for x in 3 * (np.cos(a) * plane[:, 0] + np.sin(a) * plane[:, 1])] for a in angles[:14]]
    check(frame(spark, vectors, "vec_id long, embedding array<double>, label int"), tile_bytes=64 * 8 * 24)


def test_exact_threshold(spark):
    # 9, 3, 3, 1 has length 10, so its cosine with the first axis is 9 / 10.
    out = check(frame(spark, [[1.0, 0.0, 0.0, 0.0], [9.0, 3.0, 3.0, 1.0], [9.0, 3.0, 3.0, 1.001]]))
    assert {r.vec_id: r.n_links for r in out} == {0: 1, 1: 2, 2: 1}


def test_edges(spark):
    base = families(3, [1, 4, 1], d=8)
    rows = [(i, v, 1) for i, v in enumerate(base)]
    rows += [(10, [2 * x for x in base[0]], None), (11, base[0], 1), (3, base[0], 2), (3, base[5], 2), (3, base[5], 2), (None, base[0], 2)]
    rows += [(20, None, 1), (21, [], 1), (22, [0.0] * 8, 1), (23, [None] + [1.0] * 7, 1), (24, [float("nan")] * 8, 1), (25, [float("inf")] * 8, 1)]
    rows += [(30, [1.0], 1), (31, [2.0], 1), (32, [-1.0], 1), (33, [1e-38, 0.0, 1e-38], 0), (34, [3e38, 0.0, 3e38], 0), (35, [-0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS class", "2 AS block", "3 AS n_links", "4 AS hash")
    check(df)
    assert J.linked_vectors(df.limit(0)).count() == 0
    assert J.linked_vectors(df.where("vec_id IN (20, 21, 22)")).where("n_links = 0 AND kept").count() == 3


def test_hot_vector(spark):
    df = spark.range(3000).selectExpr(
        "id AS vec_id", "array(float(1), float(CASE WHEN id % 11 = 0 THEN id % 3 ELSE 0 END), float(0)) AS embedding", "1 AS label"
    )
    check(df)


def test_other_thresholds(spark):
    vectors = families(4, [1] * 40 + [12], d=19, noise=0.9)
    for least in (0.2, 0.7, 0.99):
        check(frame(spark, vectors), least, tile_bytes=64 * 4 * 19)


def test_found_rows_grow_with_tiles(spark):
    """A family of n vectors has n^2 / 2 links; what leaves the comparisons stays linear."""
    for n in (500, 2000):
        df = frame(spark, families(5, [n], noise=0.1))
        classes = J.vector_classes(df)
        found = J.linked_classes(classes, 0.9, J.SEED, J.TILE_BYTES)
        assert found.count() <= 4 * n
        assert found.agg({"links": "sum"}).first()[0] > n * (n - 1) * 0.9


def test_pairs_are_found_once_over_blocks():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 40))
    x[1::2] = x[::2] + 0.2 * rng.standard_normal((150, 40))
    turn = J.rotation(40)
    turned = J.unit(x) @ turn
    side = J.Side(np.arange(300), np.ones(300, int), x, turned, turned.astype(np.float32))
    pairs = []
    for block in range(len(J.block_cuts(40))):
        for p, q in J.Comparison(40, 0.9, turn).links(block, side, side, True):
            pairs += zip(p.tolist(), q.tolist())
    cosine = J.unit(x) @ J.unit(x).T
    assert sorted(pairs) == sorted(zip(*(k.tolist() for k in np.nonzero(np.triu(cosine >= 0.9, 1)))))


def test_disk_is_bounded_while_tiles_meet(spark, monkeypatch, tmp_path):
    """Tiles are laid out a few blocks at a time and shuffled in rounds; nothing of either is left."""
    paths, rounds, shuffled = [], [], []
    monkeypatch.setattr(J, "HELD_BYTES", 1)
    monkeypatch.setattr(J, "CELLS_PER_CORE", 0)
    make, compare = J.new_path, J.compared
    monkeypatch.setattr(J, "new_path", lambda s, name: paths.append(make(s, name)) or paths[-1])

    def counted(packed, pairs, *args):
        entries = J.cells(pairs, J.CELL_TILES)
        shuffled.append((packed.count(), pairs.count(), entries.count()))
        compare(packed, pairs, *args)
        rounds.append(len(paths))

    monkeypatch.setattr(J, "compared", counted)
    check(frame(spark, families(5, [1] * 900 + [30, 2, 7])), tile_bytes=64 * 64 * 4)
    tile_paths = [p for p in paths if "vector-tiles" in p]
    assert len(tile_paths) == len(rounds) == 4  # a block at a time
    assert not any(os.path.exists(p.removeprefix("file:")) for p in tile_paths)
    # A pair of tiles is no copy of two tiles any more.
    assert all(tiles > 8 and 2 * entries < pairs for tiles, pairs, entries in shuffled)
    settings = spark.conf.get(next(iter(J.NO_SHUFFLE_LEFT)), None)
    assert settings in (None, "false")


def test_cells_compare_each_pair_once(spark):
    pairs = [(0, a, b) for a in range(11) for b in range(a, 11) if (a * b) % 3 != 1] + [(1, 2, 2), (1, 0, 9)]
    found = J.cells(spark.createDataFrame(pairs, "block int, first int, second int"), 4).collect()
    assert sorted((r.block, f, r.tile) for r in found for f in r.firsts) == sorted(pairs)
    there = {(r.block, r.row, r.column, r.tile) for r in found if not r.later}
    assert all((r.block, r.row, r.column, f) in there for r in found for f in r.firsts)
