import pytest
from pyspark.sql import functions as F

from sipnote import schema
from sipnote.checks.fixtures import reviews
from sipnote.plans.process import process_reviews
from sipnote.session import new_path, shared_folder
from sipnote.sources import tables as S
from sipnote.streaming.reviews import process_review_stream


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_keeps_odd_texts(spark):
    rows = [
        (1, 'a "quoted", name', "st\nyle", 4.5, "  leading, and\ntrailing \n"),
        (2, None, None, None, '""'),
        (3, "x", "y", -0.5, "back\\slash ' 日本 😀 \\"),
    ]
    df = spark.createDataFrame(rows, schema.REVIEW)
    path = new_path(spark, "csv")
    S.write_csv(df, path, rows_per_file=2)
    assert rows_of(S.read_reviews_csv(spark, path)) == rows_of(df)


def csv_file(tmp_path, text):
    path = tmp_path / "reviews.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = csv_file(tmp_path, "text,review_id,style,beer_name,other,rating_overall\nfine,7,Porter,Night,x,3.5\n")
    assert rows_of(S.read_reviews_csv(spark, path)) == [(7, "Night", "Porter", 3.5, "fine")]


def test_csv_without_a_required_column(spark, tmp_path):
    path = csv_file(tmp_path, "review_id,style,beer_name,rating_overall\n7,Porter,Night,3.5\n")
    with pytest.raises(ValueError, match="text"):
        S.read_reviews_csv(spark, path)


def test_wide_export_gets_a_stable_key(spark, tmp_path):
    names = "beer_id,beer_name,brewer_id,review_profileName,review_time,rating_overall,rating_taste,style,text"
    lines = ["1,Night,2,ann,t1,3.5,4.0,Porter,fine"] * 3 + ["1,Night,2,bob,t2,3.5,4.0,Porter,fine"]
    one = S.read_reviews_csv(spark, csv_file(tmp_path, "\n".join([names, *lines]) + "\n"))
    got = rows_of(one)
    two = rows_of(S.read_reviews_csv(spark, csv_file(tmp_path, "\n".join([names, *lines[::-1]]) + "\n")))
    assert got == two and len({r[0] for r in got}) == 4
    assert {"beer_id", "rating_taste", "review_profileName"} <= set(one.columns) and one.columns[0] == "review_id"
    assert dict(one.dtypes)["rating_taste"] == "double"


def test_required_columns(spark):
    df = spark.createDataFrame([("t", 1.0)], "text string, rating_overall double")
    assert S.require_columns(df).first().cleaned_text == "t"
    for missing in ("text", "rating_overall"):
        with pytest.raises(ValueError, match=missing):
            S.require_columns(df.drop(missing))


def test_columns_appended_and_dropped(spark):
    df = spark.createDataFrame([(1, "a", "b")], "k long, x string, y string")
    assert S.append_columns(df, ["k"], both=F.concat("x", "y")).columns == ["k", "both"]
    assert S.drop_columns(df, "x", "y").columns == ["k"]
    with pytest.raises(ValueError, match="z"):
        S.drop_columns(df, "x", "z")


def test_scan_reads_only_what_is_needed(spark, sf):
    plan = reviews(spark, sf).select("review_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_stream_gives_the_same_rows(spark, sf):
    table = reviews(spark, sf)
    source, target, checkpoint = (new_path(spark, n) for n in ("source", "target", "checkpoint"))
    S.write_parquet(table, source)
    process_review_stream(spark, source, target, checkpoint).awaitTermination()
    assert rows_of(S.read_parquet(spark, target)) == rows_of(process_reviews(table))


class Session:
    """Stands in for a session, as the setting cannot be changed while one runs."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default: settings.get(name, default))})


def test_shared_folder_comes_from_the_session():
    named = Session("spark://host:7077", **{"spark.checkpoint.dir": "/some/shared/place/"})
    assert shared_folder(named) == "/some/shared/place"
    assert shared_folder(Session("local[2]")) == shared_folder(Session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077"))


def test_empty_text_becomes_null_in_csv(spark):
    path = new_path(spark, "csv")
    S.write_csv(spark.createDataFrame([(1, "", "s", 1.0, "")], schema.REVIEW), path)
    assert rows_of(S.read_reviews_csv(spark, path)) == [(1, None, "s", 1.0, None)]
