import numpy as np
from pyspark.sql import functions as F

from sipnote.llm import neighbours as N
from sipnote.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, k, is_query):
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], dtype=float)
    out = {}
    for i in np.flatnonzero([is_query(v) for v in ids]):
        s = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def test_recall(spark, sf):
    rows = table(spark, sf, "embeddings")
    wanted = exact(rows.collect(), 20, lambda v: v % 20 == 0)
    got = {}
    for r in N.nearest(rows, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == wanted.keys()
    hits = 0
    for q, own in got.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 21))
        truth = dict(wanted[q])
        hits += len({v for _, v, _ in own} & truth.keys())
        assert all(abs(s - truth[v]) < 1e-12 for _, v, s in own if v in truth)
    assert hits >= 0.99 * 20 * len(wanted)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((4000, 64)) + 0.3, rng.standard_normal((20, 64))
    mean, turn = x.mean(axis=0), N.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    codes, length, fit = N.encode(x, mean, turn)
    rest = (q - mean) / np.linalg.norm(q - mean, axis=1)[:, None]
    estimate = (rest @ turn.T) @ N.signs(codes, 64).T / fit
    true = rest @ ((x - mean) / length[:, None]).T
    width = N.ERROR * np.sqrt((1 - fit**2) / fit**2 / 63)
    assert codes.shape == (4000, 8)
    assert abs((estimate - true).mean()) < 0.01
    assert (np.abs(estimate - true) <= width).mean() > 0.995


def test_edges(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(v) for v in rng.standard_normal(8)], 0) for i in range(1, 30)]
    bad = [
        (100, None, 0),
        (101, [0.0] * 8, 0),
        (102, [1.0, None, *[0.0] * 6], 0),
        (103, [float("nan")] * 8, 0),
        (104, [float("inf"), *[0.0] * 7], 0),
        (105, [1.0, 2.0], 0),
        (106, [], 0),
        (None, [1.0] * 8, 0),
    ]
    ties = [(200, good[0][1], 0), (201, good[0][1], 0), (202, [0.0, 1e-30, *[0.0] * 6], 0)]
    rows = spark.createDataFrame([*good, *bad, *ties], SCHEMA).withColumnRenamed("label", "code")
    out = N.nearest(rows, F.col("vec_id") % 20 == 0, 50).orderBy("query_id", "rank").collect()
    clean = [r for r in rows.collect() if r.vec_id is not None and (r.vec_id < 100 or r.vec_id >= 200)]
    wanted = exact(clean, 50, lambda v: v % 20 == 0)
    got = {}
    for r in out:
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [v for v, _ in own] for q, own in wanted.items()} and got.keys() == {20, 200}
    one = spark.createDataFrame([(20, [1.0, 2.0], 0)], SCHEMA)
    assert N.nearest(one, F.col("vec_id") % 20 == 0, 5).count() == 0
    assert N.nearest(one.limit(0), F.col("vec_id") % 20 == 0, 5).count() == 0
    assert N.nearest(rows, F.col("vec_id") == 999, 5).count() == 0


def test_blocks_of_queries(spark, sf, monkeypatch):
    rows = table(spark, sf, "embeddings")
    whole = sorted(map(tuple, N.nearest(rows, F.col("vec_id") % 20 == 0, 5).collect()))
    monkeypatch.setattr(N, "BLOCK_BYTES", 2048)
    assert sorted(map(tuple, N.nearest(rows, F.col("vec_id") % 20 == 0, 5).collect())) == whole
