"""Reading and writing review tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sipnote import schema
from sipnote.session import written
from sipnote.sources.quoted_csv import read_quoted_csv


KEY = "review_id"
# Rows of equal content are numbered in so many independent parts.
PARTS = 64


def read_reviews_csv(spark: SparkSession, path: str, multi_line: bool = True, split_files: bool = False) -> DataFrame:
    """Read review CSV by its header; quoted text may hold newlines, commas and quotes.

    Columns may come in any order. Those of the wide export are read where they are there, others
    are left out; ``beer_name``, ``style``, ``rating_overall`` and ``text`` have to be there. A file
    without ``review_id`` gets one from the values of the row, see :func:`with_content_key`. A value
    that is not of its column's type is an error.

    Spark's reader takes a file with newlines inside quotes from its start, so every file is one task.
    Large files are read by many with ``split_files=True``, see :func:`read_quoted_csv`; pass
    ``multi_line=False`` where no text holds a newline.
    """
    types = {f.name: f.dataType for f in schema.WIDE_REVIEW.fields}
    if split_files:
        rows = read_quoted_csv(spark, path, types)
        _require_header(rows.columns, path)
        return _known_columns(rows)
    options = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"', "mode": "FAILFAST"}
    header = spark.read.options(**options).csv(path).columns
    _require_header(header, path)
    # The schema follows the header of the file, so that values are parsed as their types.
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in header]
    rows = spark.read.schema(T.StructType(fields)).options(enforceSchema=False, **options).csv(path)
    return _known_columns(rows)


def _require_header(header: list[str], path: str) -> None:
    missing = [f.name for f in schema.REVIEW.fields if f.name not in header and f.name != KEY]
    if missing:
        raise ValueError(f"required columns are missing in {path}: {missing}")


def _known_columns(rows: DataFrame) -> DataFrame:
    known = [f.name for f in schema.WIDE_REVIEW.fields if f.name in rows.columns]
    return rows.select(*known) if KEY in known else with_content_key(rows.select(*known))


def with_content_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """Add a key made of the values of a row, and of a running number among equal rows.

    The same rows get the same keys in any order and partitioning. Equal rows are numbered in parts,
    so that very many of them are not numbered by one task.
    """
    columns = df.columns
    rows = written(
        df.withColumn("_hash", F.xxhash64(*columns)).withColumn(
            "_part", F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int")
        ),
        "keyed-rows",
    )
    before = Window.partitionBy("_hash").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # Only rows whose content repeats have parts to add up.
    sizes = rows.groupBy("_hash", "_part").count()
    offsets = sizes.select("_hash", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_skip"))
    within = Window.partitionBy("_hash", "_part").orderBy(F.lit(0))
    number = F.col("_skip") + F.row_number().over(within)
    keyed = rows.join(offsets, ["_hash", "_part"]).withColumn(key, F.xxhash64("_hash", number))
    return keyed.select(key, *columns)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 250_000) -> None:
    """Write CSV that :func:`read_reviews_csv` reads back unchanged.

    CSV does not tell an empty text from a missing one: both come back as null. Files are kept
    small, as each is read by one task.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str) -> None:
    """Write the working format."""
    df.write.mode("overwrite").parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give every core work where a scan has fewer splits than there are cores.

    Text functions cost far more than moving the rows, so small inputs (less than one split
    per core) are worth a round-robin exchange. Large inputs pass through without one.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def require_columns(df: DataFrame) -> DataFrame:
    """Check the columns modelling needs; a missing ``cleaned_text`` falls back to ``text``."""
    for name in ("text", "rating_overall"):
        if name not in df.columns:
            raise ValueError(f"required column is missing: {name}")
    return df if "cleaned_text" in df.columns else df.withColumn("cleaned_text", F.col("text"))


def append_columns(df: DataFrame, keep: list[str], **new: "F.Column") -> DataFrame:
    """Chosen source columns followed by computed ones, from the same row."""
    return df.select(*keep, *[column.alias(name) for name, column in new.items()])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; a name that does not exist is an error, as a typo would go unseen."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*names)
