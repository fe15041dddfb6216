"""Left join of many rows to a table with one row per key, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table up to this many bytes is sent to every executor; beyond it the join shuffles.
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one key that one task may hold in the shuffled join.
ROWS_PER_TASK = 200_000


def table_bytes(table: DataFrame) -> int:
    """Size of the values of a table, by one aggregation over it."""
    sizes = [
        F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8)
        for f in table.schema.fields
    ]
    row = sum(sizes[1:], sizes[0]) + F.lit(16 * len(sizes))
    return table.agg(F.sum(row.cast("long"))).first()[0] or 0


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return table_bytes(table) <= limit


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: list[str],
    limit: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every row of ``rows`` with the columns of ``table`` for its ``key``, or nulls.

    ``table`` has one row per key; ``spread_by`` names columns that tell the rows of one key
    apart. A table of checked small size is broadcast. A larger one is joined by a shuffle in
    which a hot key is split over as many salts as its row count asks for, and only the table
    rows of hot keys are repeated, once per salt. Every row is kept.
    """
    if fits_broadcast(table, limit):
        return rows.join(F.broadcast(table), key, "left")
    # At most (rows / rows_per_task) keys are hot, at 16 bytes each: 50 billion rows give 4 MB.
    # Keys are compared by hash here; a collision merely salts one more key.
    hot = (
        rows.groupBy(F.xxhash64(key).alias("_hash"))
        .count()
        .where(F.col("count") > rows_per_task)
        .select("_hash", F.ceil(F.col("count") / rows_per_task).alias("_salts"))
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    left = (
        rows.withColumn("_hash", F.xxhash64(key))
        .join(F.broadcast(hot), "_hash", "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts))
        .drop("_hash", "_salts")
    )
    right = (
        table.withColumn("_hash", F.xxhash64(key))
        .join(F.broadcast(hot), "_hash", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1)))
        .drop("_hash", "_salts")
    )
    return left.join(right, [key, "_salt"], "left").drop("_salt")
