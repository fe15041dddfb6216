"""Looking at a table: nulls per column and a short preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sipnote.operators.ranking import first_n


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: column_name, n_rows, n_columns, n_null. One aggregation."""
    columns = columns or df.columns
    counts = df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"null_{c}").alias("n_null")) for c in columns]
    )
    return counts.select("n_rows", F.lit(len(df.columns)).alias("n_columns"), F.explode(entries).alias("e")).select(
        "e.column_name", "n_rows", "n_columns", "e.n_null"
    )


def preview(df: DataFrame, key: str, n: int, columns: list[str], chars: int) -> DataFrame:
    """The first ``n`` rows with long texts cut for display; other columns as they are."""
    cut = [F.left(F.col(c), F.lit(chars)).alias(c) for c in columns]
    return first_n(df, key, n).select(*[c for c in df.columns if c not in columns], *cut)
