"""Small helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A table is broadcast only if its rows times a stated width stay below this.
BROADCAST_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, or the empty string where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether all rows of ``df``, at ``row_bytes`` each, stay below ``limit``; counts at most that many."""
    most = max(1, limit // row_bytes)
    return df.limit(most + 1).count() <= most


def maybe_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """Mark ``df`` for a broadcast if its measured size allows, else leave the join to a shuffle."""
    return F.broadcast(df) if small(df, row_bytes) else df


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is planned and run inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
