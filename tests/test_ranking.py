import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sipnote.operators import ranking as R
from tests.conftest import plan_of


def md5_order(ids):
    return sorted(ids, key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("n", [0, 1, 7, 500, 999, 1000, 5000])
def test_first_n_on_uneven_ids(spark, n):
    # Most ids fall into one bucket of the histogram.
    ids = list(range(-400, 500)) + [10**12 + i for i in range(100)]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "review_id long").repartition(7)
    assert sorted(r[0] for r in R.first_n(df, "review_id", n).collect()) == sorted(ids)[:n]


@pytest.mark.parametrize("n, parts", [(0, 3), (1, 1), (50, 8), (300, 5), (400, 2)])
def test_seeded_sample(spark, n, parts):
    df = spark.range(300).withColumnRenamed("id", "review_id").repartition(parts)
    assert {r[0] for r in R.seeded_sample(df, "review_id", n).collect()} == set(md5_order(range(300))[:n])


def test_empty_table(spark):
    df = spark.range(0).select(F.col("id").alias("review_id"), F.lit("x").alias("label"))
    assert R.first_n(df, "review_id", 3).count() == 0
    assert R.seeded_sample(df, "review_id", 3).count() == 0
    assert R.stratified_split(df, "review_id", "label").count() == 0


def quotas_of(spark, counts):
    table = spark.createDataFrame(list(counts.items()), "label string, n long")
    return {r.label: r.quota for r in R.split_quotas(table).collect()}


def test_split_quotas_add_up(spark):
    counts = {"Positive": 357, "Neutral": 376, "Negative": 267}
    assert quotas_of(spark, counts) == {"Positive": 71, "Neutral": 75, "Negative": 54}
    assert quotas_of(spark, {"a": 1}) == {"a": 1}
    assert sum(quotas_of(spark, {"a": 3, "b": 3, None: 3}).values()) == 2


@pytest.mark.parametrize("parts", [1, 9])
def test_stratified_split_is_exact_and_stable(spark, parts):
    label = F.when(F.col("id") % 3 == 0, "x").when(F.col("id") < 50, None).otherwise("y")
    df = spark.range(1000).select(F.col("id").alias("review_id"), label.alias("label")).repartition(parts)
    got = {r.review_id: (r.label, r.split) for r in R.stratified_split(df, "review_id", "label").collect()}
    groups = {}
    for i, (name, _) in got.items():
        groups.setdefault(name, []).append(i)
    quotas = quotas_of(spark, {k: len(v) for k, v in groups.items()})
    expected = {i for name, ids in groups.items() for i in md5_order(ids)[: quotas[name]]}
    assert {i for i, (_, s) in got.items() if s == "test"} == expected and len(expected) == 200


def test_folds_are_balanced_within_labels(spark):
    df = spark.range(500).select(F.col("id").alias("k"), F.when(F.col("id") < 170, "a").otherwise("b").alias("label"))
    rows = R.stratified_folds(df, "k", "label", 3).collect()
    order = {name: md5_order([r.k for r in rows if r.label == name]) for name in "ab"}
    assert all(r.fold == order[r.label].index(r.k) % 3 for r in rows) and len(rows) == 500


@pytest.mark.parametrize("labels", [1_000, 5_000])
def test_many_labels(spark, labels):
    df = spark.range(4 * labels).withColumn("label", (F.col("id") % labels).cast("string"))
    split = R.stratified_split(df, "id", "label")
    assert split.where("split = 'test'").count() == -(-4 * labels // 5)
    per_label = split.groupBy("label").agg(F.count_if(F.col("split") == "test").alias("n"))
    assert per_label.agg(F.max("n")).first()[0] == 1


@pytest.mark.parametrize("n", [1, 2, 5, 10, 11, 12, 13, 20])
def test_null_keys_come_last(spark, n):
    rows = [(i, f"t{i}") for i in range(10)] + [(None, f"null{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "k long, text string").repartition(3)
    for chosen in (R.first_n(df, "k", n), R.seeded_sample(df, "k", n)):
        got = [r.k for r in chosen.collect()]
        assert len(got) == min(n, 13) and sum(k is not None for k in got) == min(n, 10)
    assert sorted(r.k for r in R.first_n(df, "k", n).collect() if r.k is not None) == list(range(min(n, 10)))


def test_repeated_keys_are_told_apart(spark):
    df = spark.createDataFrame([(1, f"t{i}") for i in range(40)] + [(0, "a"), (2, "b")], "k long, text string")
    for n in (1, 7, 41, 42):
        assert R.first_n(df, "k", n).count() == n and R.seeded_sample(df, "k", n).count() == n


def test_null_labels_and_keys_keep_their_rows(spark):
    rows = [(i if i % 7 else None, "x" if i % 3 else None, i) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, label string, other int")
    folds = R.stratified_folds(df, "k", "label", 3)
    assert folds.count() == 60 and folds.where("label IS NULL").groupBy("fold").count().count() == 3
    split = R.stratified_split(df, "k", "label")
    assert split.count() == 60 and split.where("split = 'test'").count() == 12


def test_outliers_do_not_crowd_the_rows_ranked(spark, monkeypatch):
    monkeypatch.setattr(R, "RANKED_ROWS", 50)
    ids = spark.range(200_000).select(F.col("id").alias("k")).unionByName(spark.createDataFrame([(10**17,)], "k long"))
    assert R.first_n(ids, "k", 150_000).agg(F.max("k"), F.count("k")).first() == (149_999, 150_000)
    same = spark.range(500).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("other"))
    assert R.first_n(same, "k", 123).count() == 123


def test_refined_brackets(spark, monkeypatch):
    """Many rounds of sketches, and sketches that miss, give the same rows."""
    monkeypatch.setattr(R, "RANKED_ROWS", 40)
    monkeypatch.setattr(R, "EXACT_ROWS", 20)
    monkeypatch.setattr(R, "SKETCH", 64)
    df = spark.range(6000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "x").alias("label"))
    for slack in (0.05, 1e-6):
        monkeypatch.setattr(R, "SLACK", slack)
        split = R.stratified_split(df, "k", "label").where("split = 'test'")
        got = {name: {r.k for r in split.where(F.col("label").eqNullSafe(F.lit(name))).collect()} for name in ("x", None)}
        assert got["x"] == set(md5_order([i for i in range(6000) if i % 3])[:800])
        assert got[None] == set(md5_order([i for i in range(6000) if i % 3 == 0])[:400])
        assert {r.k for r in R.first_n(df, "k", 2345).collect()} == set(range(2345))


def test_numbers_of_all_kinds(spark):
    values = [-1.5, float("nan"), float("inf"), float("-inf"), 0.0, 7.25, None, 3.0]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k double, i int")
    order = [3, 0, 4, 7, 5, 2, 1, 6]
    for n in range(9):
        assert {r.i for r in R.first_n(df, "k", n).collect()} == set(order[:n])
    tens = spark.range(50).selectExpr("CAST(id AS DECIMAL(20,3)) / 7 AS k", "id AS i", "DATE'2020-01-01' AS d")
    assert {r.i for r in R.first_n(tens, "k", 9).collect()} == set(range(9))
    ends = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (0,), (None,)], "k long")
    assert [sorted(str(r.k) for r in R.first_n(ends, "k", n).collect()) for n in (1, 3)] == [["-9223372036854775808"], ["-9223372036854775808", "0", "9223372036854775807"]]


def test_hot_keys_and_null_keys_are_divided(spark, monkeypatch):
    monkeypatch.setattr(R, "RANKED_ROWS", 100)
    df = spark.range(9000).selectExpr("IF(id % 3 = 0, NULL, IF(id % 3 = 1, 5, id)) AS k", "'x' AS label", "id AS other")
    for n in (100, 4000, 7000):
        assert R.first_n(df, "k", n).count() == n and R.seeded_sample(df, "k", n).count() == n
    assert R.stratified_split(df, "k", "label").where("split = 'test'").count() == 1800
    sizes = R.stratified_folds(df, "k", "label", 3).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in sizes) == [3000] * 3


def test_split_reads_key_and_label_only(spark, tmp_path):
    """The passes before the last leave wide columns alone, and rows stay where they are."""
    rows = spark.range(30_000).selectExpr("id AS k", "CAST(id % 3 AS STRING) AS label", "repeat('text ', 50) AS text")
    rows.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    split = R.stratified_split(df, "k", "label").select("k", "split")
    plan = plan_of(split)
    assert "text" not in plan and "Exchange hashpartitioning" not in plan
    assert split.where("split = 'test'").count() == 6000
