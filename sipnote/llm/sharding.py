"""Shards of nearly equal bytes, by a minimax contiguous partition of ordered atomic groups.

Rows with equal texts form a group, which no cut divides. Groups are ordered by the digest of their
text. The smallest capacity for which a greedy pass needs no more than the wanted number of shards
is found by binary search, and the cuts are where that pass closes its shards.

The groups never reach the driver. It sees sums of groups by leading digits of the digest: first
65,536 of them, then 256 finer ones for each range that may still hold a cut. A greedy pass which
may cut anywhere inside a range, and one which may not, bound the capacity and every cut from both
sides; ranges between the bounds are refined until each is one group. Then both passes agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sipnote.llm.common import whole
from sipnote.session import written

# Rows of a shard are numbered in so many independent parts; the table of their sizes stays small.
PARTS = 2048
FIRST_DIGITS = 4
MORE_DIGITS = 2


@dataclass
class Ranges:
    """Consecutive ranges of groups: leading digits, bytes, and whether a cut may fall inside."""

    keys: np.ndarray
    size: np.ndarray
    open: np.ndarray

    def __post_init__(self) -> None:
        order = np.argsort(self.keys)
        self.keys, self.size, self.open = self.keys[order], self.size[order], self.open[order]
        self.ends = np.cumsum(self.size)

    def cuts(self, capacity: int, shards: int, inside: bool) -> tuple[list[int], int]:
        """Where a greedy pass closes its shards, and the range that stopped it (or -1)."""
        at, found, total = 0, [], int(self.ends[-1])
        for _ in range(shards):
            i = int(np.searchsorted(self.ends, at + capacity, side="right"))
            if i == len(self.ends):
                to = total
            elif inside and self.open[i]:
                to = at + capacity
            else:
                to = int(self.ends[i - 1]) if i else 0
            if to <= at < total:
                return found, i
            at = to
            found.append(at)
        return found, -1

    def smallest(self, shards: int, inside: bool, low: int) -> int:
        """The smallest capacity from ``low`` up for which ``shards`` shards hold everything."""
        total = int(self.ends[-1])
        high = max(low, total)
        while low < high:
            middle = (low + high) // 2
            found, stopped = self.cuts(middle, shards, inside)
            if stopped < 0 and found[-1] >= total:
                high = middle
            else:
                low = middle + 1
        return low


def _ranges(groups: DataFrame, digits: int, within: list[str] | None = None, length: int = 0) -> list:
    if within is not None:
        groups = groups.where(F.substring("digest", 1, length).isin(within))
    return (
        groups.groupBy(F.substring("digest", 1, digits).alias("key"))
        .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.max("bytes").alias("most"))
        .collect()
    )


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[str], int]:
    """Leading digits at which each shard but the first begins, and the capacity of a shard.

    ``groups`` has one row per group: ``digest`` (hex) and ``bytes``. There may be fewer cuts than
    shards less one; the last shards are empty then. No groups: no cuts, capacity 0.
    """
    rows = _ranges(groups, FIRST_DIGITS)
    if not rows:
        return [], 0
    least = max(r["most"] for r in rows)
    parts = {r["key"]: (r["bytes"], r["n"] > 1) for r in rows}
    while True:
        keys = np.array(list(parts))
        ranges = Ranges(
            keys, np.array([parts[k][0] for k in keys], dtype=np.int64), np.array([parts[k][1] for k in keys])
        )
        total = int(ranges.ends[-1])
        low = ranges.smallest(shards, True, max(least, -(-total // shards)))
        high = ranges.smallest(shards, False, low)
        near, stopped = ranges.cuts(low, shards, False)
        if stopped >= 0:
            refine = [stopped]
        else:
            far, _ = ranges.cuts(high, shards, True)
            refine = []
            for a, b in zip(near[:-1], far[:-1]):
                first, last = np.searchsorted(ranges.ends, [a, b], side="right")
                refine += range(first, min(last, len(ranges.ends) - 1) + 1)
        refine = sorted({i for i in refine if ranges.open[i]})
        if not refine:
            found, _ = ranges.cuts(high, shards, False)
            starts = [np.searchsorted(ranges.ends, c, side="right") for c in found[:-1] if c < total]
            return [str(ranges.keys[i]) for i in starts], high
        by_length: dict[int, list[str]] = {}
        for key in map(str, ranges.keys[refine]):
            by_length.setdefault(len(key), []).append(key)
        for length, within in by_length.items():
            for k in within:
                del parts[k]
            for r in _ranges(groups, length + MORE_DIGITS, within, length):
                parts[r["key"]] = (r["bytes"], r["n"] > 1)


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row into a shard, and number the rows of each shard from 0 without gaps.

    Returns ``doc_id, size, text_crc32, shard, slot``. The size of a row is the bytes of its text
    plus 1, so that empty and null texts (which are equal) count too. Rows with equal texts share a
    shard, also where they are a large part of the table: a shard is at least as large as the
    largest group. Repeated rows and null ids are rows like any other. An empty table gives an empty
    result. Other columns are ignored, whatever their names.
    """
    text = whole(text_col)
    rows = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("digest"),
            F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int").alias("part"),
        ),
        "shard-rows",
    )
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    cuts, _ = minimax_cuts(groups, shards)
    number = F.lit(0)
    for cut in cuts:
        number = number + (F.col("digest") >= F.lit(cut)).cast("int")
    placed = rows.select("doc_id", "size", "text_crc32", "part", number.cast("int").alias("shard"))
    # At most shards * PARTS rows, whatever the input.
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "part")
        .count()
        .select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    return (
        placed.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot"))
    )


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows, all columns, into one folder per shard; the cuts are those of :func:`shard`."""
    text = whole(text_col)
    groups = written(
        docs.select((F.octet_length(text) + 1).cast("long").alias("size"), F.sha2(text, 256).alias("digest"))
        .groupBy("digest")
        .agg(F.sum("size").alias("bytes")),
        "shard-groups",
    )
    cuts, _ = minimax_cuts(groups, shards)
    number = F.lit(0)
    for cut in cuts:
        number = number + (F.sha2(text, 256) >= F.lit(cut)).cast("int")
    docs.withColumn("shard", number.cast("int")).write.partitionBy("shard").parquet(path)
