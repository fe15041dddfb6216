"""CSV files with line breaks inside quotes, each read by many tasks.

Whether a line break ends a record depends on the quotes before it, up to the start of the file. Each
byte range of a file is read by its own task, which counts its quotes; running sums over the ranges,
a few numbers each, then tell with what parity a range begins. With that known, every range finds
its own record borders, and only what runs over the end of a range is joined to the record it belongs
to. Records are parsed by Spark's own CSV function.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sipnote.operators.lookup import fits_broadcast
from sipnote.session import written

OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
RANGE = ["file", "range"]


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, id, line): physical lines; ``range`` is the first byte of the task's part of the file."""
    lines = spark.read.option("lineSep", "\n").text(path)
    columns = {"file": F.col("_metadata.file_path"), "range": F.col("_metadata.file_block_start")}
    return lines.select(*[c.alias(n) for n, c in columns.items()], F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))


def _quotes(line: F.Column) -> F.Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def range_parities(lines: DataFrame) -> DataFrame:
    """(file, range, open): whether a range begins inside quotes. A file that ends inside quotes is an error."""
    counts = written(lines.groupBy(*RANGE).agg(F.sum(_quotes(F.col("line"))).alias("quotes")), "quote-counts")
    odd = counts.groupBy("file").agg(F.sum("quotes").alias("quotes")).where("quotes % 2 = 1").first()
    if odd is not None:
        raise ValueError(f"a quote is never closed in {odd['file']}")
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*RANGE, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("open"))


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if fits_broadcast(table) else table


def _range_pieces(lines: DataFrame, parities: DataFrame) -> DataFrame:
    """(file, range, number, piece): the records that begin in a range, numbered from 1; number 0 is the end
    of a record that began before. Lines are shuffled once, by range."""
    in_order = Window.partitionBy(*RANGE).orderBy("id")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.coalesce(F.sum(_quotes(F.col("line"))).over(before), F.lit(0)) + F.col("open").cast("int")
    marked = lines.join(_small(parities), RANGE).withColumn("inside", quotes % 2 == 1)
    # Blank lines between records are no records.
    begins = ~F.col("inside") & ~F.col("line").isin("", "\r")
    numbered = marked.withColumn("number", F.sum(begins.cast("int")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    own = numbered.where(F.col("inside") | ~F.col("line").isin("", "\r"))
    in_lines = F.transform(F.array_sort(F.collect_list(F.struct("id", "line"))), lambda x: x["line"])
    return own.groupBy(*RANGE, "number").agg(F.array_join(in_lines, "\n").alias("piece"))


def csv_records(lines: DataFrame) -> DataFrame:
    """(file, range, number, record): whole records as text; number 1 of range 0 is a file's first record."""
    pieces = written(_range_pieces(lines, range_parities(lines)), "csv-pieces")
    ranges = pieces.groupBy(*RANGE).agg(F.max("number").alias("begun"))
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    latest = lambda c: F.last(F.when(F.col("begun") > 0, F.col(c)), ignorenulls=True).over(earlier)
    owners = ranges.select(*RANGE, latest("range").alias("owner"), latest("begun").alias("owner_number"))
    # At most one for each range.
    ends = pieces.where("number = 0").join(_small(written(owners, "csv-owners")), RANGE)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("range", "piece"))), lambda x: x["piece"])
    ends = ends.groupBy("file", F.col("owner").alias("range"), F.col("owner_number").alias("number")).agg(
        F.array_join(in_order, "\n").alias("rest")
    )
    joined = pieces.where("number > 0").join(_small(written(ends, "csv-ends")), [*RANGE, "number"], "left")
    # A record ends with \n or \r\n.
    record = F.regexp_replace(F.concat_ws("\n", "piece", "rest"), r"\r\z", "")
    return joined.select(*RANGE, "number", record.alias("record"))


def read_quoted_csv(spark: SparkSession, path: str, types: dict[str, T.DataType]) -> DataFrame:
    """The rows of CSV files with a header, columns in its order, strings unless ``types`` names another type.

    Files are read in as many tasks as their size asks for, line breaks in quotes or not. Quotes inside
    quotes are doubled, and a field that holds a quote is quoted. Records end with ``\\n`` or ``\\r\\n``; blank
    lines between them are passed over. All files need the same header. A quote that is never closed, a record
    of another length and a value of another type are errors, the latter two when the rows are read. Compressed
    files are one range each. Files without any record give no rows and no columns.
    """
    records = csv_records(csv_lines(spark, path))
    is_header = (F.col("range") == 0) & (F.col("number") == 1)
    headers = records.where(is_header).select(F.ltrim(F.col("record"), F.lit("﻿")).alias("record"))
    found = [r["record"] for r in headers.distinct().limit(2).collect()]
    if not found:
        return spark.createDataFrame([], T.StructType())
    if len(found) > 1:
        raise ValueError(f"headers differ in {path}: {found}")
    names = next(csv.reader(io.StringIO(found[0], newline="")))
    fields = [f"`{n.replace('`', '``')}` {types.get(n, T.StringType()).simpleString()}" for n in names]
    parsed = F.from_csv("record", ", ".join(fields), OPTIONS)
    rows = records.where(~is_header).select(parsed.alias("row"))
    return rows.select("row.*")
