"""Split reading of quoted CSV gives the rows of the one-task reader, wherever the ranges end."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sipnote import schema
from sipnote.checks import queries
from sipnote.checks.fixtures import reviews
from sipnote.session import new_path
from sipnote.sources import quoted_csv as Q
from sipnote.sources import tables as S
from tests.test_sources import csv_file, rows_of

HEADER = "review_id,beer_name,style,rating_overall,text"


@pytest.fixture
def small_ranges(spark):
    """Ranges of so many bytes."""
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def of(size):
        for name in before:
            spark.conf.set(name, str(size))

    yield of
    for name, value in before.items():
        spark.conf.set(name, value)


def odd_reviews(spark, n=120):
    rng = random.Random(5)
    parts = ["\n", '"', ",", '""', "malt ", "\n\n", "日本 ", "\\", "'", " hop", "\n,\n", "😀"]
    texts = ["x" + "".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]
    rows = [(i, f'n"{i}', None if i % 7 else "a\nb", i / 2, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema.REVIEW)


@pytest.mark.parametrize("size", [64, 300, 1_000_000])
def test_rows_equal_those_of_the_one_task_reader(spark, small_ranges, size):
    df = odd_reviews(spark)
    path = new_path(spark, "csv")
    S.write_csv(df.coalesce(1), path)
    small_ranges(size)
    ranges = Q.csv_lines(spark, path).select("file", "range").distinct().count()
    assert ranges == 1 if size == 1_000_000 else ranges > 5
    assert rows_of(S.read_reviews_csv(spark, path, split_files=True)) == rows_of(df)
    assert rows_of(S.read_reviews_csv(spark, path)) == rows_of(df)


def test_one_record_over_many_ranges(spark, small_ranges, tmp_path):
    long = "\n".join(f'line {i}, ""quoted""' for i in range(200))
    path = csv_file(tmp_path, f'{HEADER}\n1,a,b,1.5,"{long}"\n\n2,"c\n",d,2.5,e')
    small_ranges(50)
    rows = rows_of(S.read_reviews_csv(spark, path, split_files=True))
    assert rows == [(1, "a", "b", 1.5, long.replace('""', '"')), (2, "c\n", "d", 2.5, "e")]


def test_line_ends_blank_lines_and_mark(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_bytes(f'﻿{HEADER}\r\n\r\n1,a,b,1.5,"x\r\n\r\ny"\r\n\n2,,,,\r\n'.encode())
    rows = rows_of(S.read_reviews_csv(spark, str(path), split_files=True))
    assert rows == [(1, "a", "b", 1.5, "x\r\n\r\ny"), (2, None, None, None, None)]


def test_several_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f'{HEADER}\n1,a,b,1.5,"x\ny"\n')
    (tmp_path / "b.csv").write_text(f"{HEADER}\n2,a,b,1.5,z")
    assert [r[0] for r in rows_of(S.read_reviews_csv(spark, str(tmp_path), split_files=True))] == [1, 2]
    (tmp_path / "c.csv").write_text("review_id,text\n2,a")
    with pytest.raises(ValueError, match="headers differ"):
        S.read_reviews_csv(spark, str(tmp_path), split_files=True)


def test_what_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="never closed"):
        S.read_reviews_csv(spark, csv_file(tmp_path, f'{HEADER}\n1,a,b,1.5,"x\n'), split_files=True)
    with pytest.raises(ValueError, match="text"):
        S.read_reviews_csv(spark, csv_file(tmp_path, "review_id,style\n1,a\n"), split_files=True)
    for bad in ("1,a,b,1.5\n", "1,a,b,1.5,x,y\n", "1,a,b,good,x\n"):
        with pytest.raises(Exception, match="(?i)malformed"):
            S.read_reviews_csv(spark, csv_file(tmp_path, f"{HEADER}\n{bad}"), split_files=True).collect()


def test_header_alone_and_missing_key(spark, tmp_path):
    assert rows_of(S.read_reviews_csv(spark, csv_file(tmp_path, HEADER + "\n"), split_files=True)) == []
    path = csv_file(tmp_path, 'text,beer_name,style,rating_overall\n"a\nb",n,s,1\n')
    (row,) = S.read_reviews_csv(spark, path, split_files=True).select(F.col("review_id").isNotNull().alias("k"), "text").collect()
    assert row.k and row.text == "a\nb"


def test_csv_query_writes_files_of_bounded_size(spark, sf, monkeypatch):
    """No task writes the whole table; all rows come back from the files."""
    paths = []
    monkeypatch.setattr(queries, "CSV_FILE_BYTES", 1 << 16, raising=False)
    monkeypatch.setattr(queries, "new_path", lambda s, name: paths.append(new_path(s, name)) or paths[-1])
    back = queries.QUERIES["csv_split_roundtrip"](spark, sf)
    assert len([f for f in os.listdir(paths[0]) if f.endswith(".csv")]) > 1
    wanted = reviews(spark, sf).select(*back.columns)
    assert sorted(back.collect(), key=str) == sorted(wanted.collect(), key=str)
