"""Best-fit packing of tokenised documents into sequences of fixed length.

Tokens are counted in the tasks; what is packed is the histogram of piece lengths, which has at most
as many entries as a sequence has tokens, whatever the input. Gaps are first filled exactly: a piece
is completed by a single, a pair or a triple of lengths that sum to its gap, found by their
complements, in as many copies as the counts allow. What is left goes to the best-fitting gaps.
The plan is a small table of intervals: pieces of a length, in any order, number so and so to so and
so, go to these sequences at that offset. Pieces are numbered by windows over small parts.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sipnote.llm.common import maybe_broadcast, settings, whole
from sipnote.session import written

SEQUENCE = 2048
END = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Texts of these characters alone are split alike by both tokenizer libraries.
PLAIN = re.compile(r"[\n\t\r -~¡-ɏ‐-…]*")


@lru_cache(maxsize=1)
def _whole_tokenizer(name: str):
    """The file's own tokenizer; loaded where a text asks for it."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))


@lru_cache(maxsize=1)
def _ranks(name: str):
    """The same vocabulary as ranks, and the names of the added tokens."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as file:
        added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return fast, tuple(added)


def token_ids(text: str, tokenizer: str) -> np.ndarray:
    """The ids of the named tokenizer file, without special tokens added.

    The file's vocabulary also comes as ranks, which encode several times faster. They are used for
    texts of plain characters without the name of an added token; others go through the file.
    """
    fast, added = _ranks(tokenizer)
    if PLAIN.fullmatch(text) and not any(name in text for name in added):
        return fast.encode_to_numpy(text, disallowed_special=())
    return np.array(_whole_tokenizer(tokenizer).encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def cut(total: int, sequence: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` ids: whole sequences, the first may be shorter."""
    first = total % sequence or sequence
    return [(0, first)] + [(s, sequence) for s in range(first, total, sequence)]


def pieces(
    docs: DataFrame,
    sequence: int = SEQUENCE,
    tokenizer: str = "byte_bpe_50k",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenise whole texts, end each with id 0, cut what is longer than a sequence, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = token_ids(text, tokenizer).astype("<u4", copy=False).tobytes() + END.to_bytes(4, "little")
                for i, (start, length) in enumerate(cut(len(data) // 4, sequence)):
                    row = (doc_id, i, start, length, zlib.crc32(data[4 * start : 4 * (start + length)]))
                    for column, value in zip(out, row):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}):
        found = rows.mapInArrow(run, PIECES)
        return written(found.withColumn("row", F.monotonically_increasing_id()), "token-pieces")


@dataclass
class Group:
    """Sequences filled alike: the first of their numbers, how many, (length, times) runs, free tokens."""

    first: int
    copies: int
    runs: tuple[tuple[int, int], ...]
    free: int


class Plan:
    """Packs a histogram of lengths; ``groups`` hold the result."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.groups: list[Group] = []
        self.used = 0
        self._exact()
        self._best_fit()

    def _take(self, lengths: list[int]) -> None:
        """Fill as many sequences with these lengths as the counts allow."""
        times = {x: lengths.count(x) for x in lengths}
        copies = min(int(self.left[x]) // n for x, n in times.items())
        for x, n in times.items():
            self.left[x] -= n * copies
        runs = tuple(sorted(times.items(), reverse=True))
        self.groups.append(Group(self.used, copies, runs, self.capacity - sum(lengths)))
        self.used += copies

    def _has(self, lengths: list[int]) -> bool:
        return all(self.left[x] >= lengths.count(x) for x in lengths)

    def _pair(self, gap: int, taken: list[int]) -> list[int] | None:
        """Two lengths that sum to ``gap`` and are there besides ``taken``, the larger as large as can be."""
        if gap < 2:
            return None
        there = self.left > 0
        low = gap // 2
        small = np.arange(1, low + 1)
        for a in small[there[small] & there[gap - small]]:
            if self._has([*taken, int(gap - a), int(a)]):
                return [int(gap - a), int(a)]
        return None

    def _complement(self, length: int) -> list[int] | None:
        """One, two or three lengths that exactly fill what ``length`` leaves."""
        gap = self.capacity - length
        if gap == 0:
            return []
        if self._has([length, gap]):
            return [gap]
        if pair := self._pair(gap, [length]):
            return pair
        third = (gap + 2) // 3
        for a in (np.flatnonzero(self.left[third : max(third, gap - 1)]) + third)[::-1].tolist():
            if self._has([length, a]) and (pair := self._pair(gap - a, [length, a])):
                return [a, *pair]
        return None

    def _exact(self) -> None:
        for length in range(self.capacity, 0, -1):
            while self.left[length] and (fill := self._complement(length)) is not None:
                self._take([length, *fill])

    def _best_fit(self) -> None:
        open_: dict[int, list[Group]] = {}
        for length in range(self.capacity, 0, -1):
            while n := int(self.left[length]):
                gap = min((g for g in open_ if g >= length), default=None)
                if gap is None:
                    times = min(self.capacity // length, n)
                    copies = n // times
                    free = self.capacity - times * length
                    group = Group(self.used, copies, ((length, times),), free)
                    self.used += copies
                    self.left[length] -= copies * times
                else:
                    old = open_[gap].pop()
                    if not open_[gap]:
                        del open_[gap]
                    times = min(gap // length, n)
                    copies = min(old.copies, n // times)
                    if copies < old.copies:
                        rest = Group(old.first + copies, old.copies - copies, old.runs, gap)
                        open_.setdefault(gap, []).append(rest)
                    group = Group(old.first, copies, (*old.runs, (length, times)), gap - times * length)
                    self.left[length] -= copies * times
                open_.setdefault(group.free, []).append(group)
        self.groups += [g for same in open_.values() for g in same]

    def intervals(self) -> list[tuple[int, int, int, int, int, int]]:
        """(length, from, to, first sequence, offset, times) for the numbered pieces of each length."""
        out, given = [], dict.fromkeys(range(self.capacity + 1), 0)
        for g in self.groups:
            offset = 0
            for length, times in g.runs:
                n = g.copies * times
                out.append((length, given[length], given[length] + n, g.first, offset, times))
                given[length] += n
                offset += length * times
        return out


def pack(rows: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """Place every row of ``rows`` (length from 1 to ``capacity``, row: a number of its own).

    Returns all columns but ``row``, with sequence_id and offset. ``rows`` has to be a written
    table, as it is read more than once. Ties between rows of one length go by ``row``.
    """
    spark = rows.sparkSession
    parts = max(16, min(4096, rows.count() // 250_000))
    numbered = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    counts = written(numbered.groupBy("length", "part").count(), "length-counts")
    # One entry per length, at most ``capacity`` of them.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    schema = "length long, start_at long, end_at long, first long, base long, times long"
    intervals = spark.createDataFrame(Plan(histogram, capacity).intervals(), schema)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("skip"))
    within = Window.partitionBy("length", "part").orderBy("row")
    number = F.col("skip") + F.row_number().over(within) - 1
    ranked = numbered.join(maybe_broadcast(offsets, 48), ["length", "part"]).withColumn("number", number)
    # The plan has a few entries per length at most; see Plan.
    here = ranked.alias("r").join(
        F.broadcast(intervals).alias("i"),
        (F.col("r.length") == F.col("i.length"))
        & (F.col("r.number") >= F.col("i.start_at"))
        & (F.col("r.number") < F.col("i.end_at")),
    )
    nth = F.col("r.number") - F.col("i.start_at")
    return here.select(
        *[F.col(f"r.{c}") for c in rows.columns if c != "row"],
        (F.col("i.first") + F.floor(nth / F.col("i.times"))).cast("long").alias("sequence_id"),
        (F.col("i.base") + (nth % F.col("i.times")) * F.col("r.length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    sequence: int = SEQUENCE,
    tokenizer: str = "byte_bpe_50k",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenise and pack whole documents.

    Returns one row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A
    null or empty text is the end id alone. Repeated and null ids are packed row by row. An empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    return pack(pieces(docs, sequence, tokenizer, id_col, text_col), sequence)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids). ``doc_id`` has to be unique here."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [[*token_ids(t, tokenizer).tolist(), END] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}):
        rows = docs.select(F.col("doc_id").cast("long"), whole("text").alias("text"))
        ids = written(rows.mapInArrow(run, "doc_id long, ids array<int>"), "token-ids")
    part = F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    there = packed.join(ids, "doc_id").select("sequence_id", F.struct("offset", part.alias("ids")).alias("p"))
    ordered = F.array_sort(F.collect_list("p"))
    return there.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
