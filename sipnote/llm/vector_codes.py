"""Vector codes: every part of a vector becomes the number of its nearest codebook entry.

Components are whole numbers, so all distances are exact. The nearest entry is found by equal-average
search: entries are sorted by the sum of their components, and from the place of a part's own sum the
search goes outward on both sides. The squared gap of two sums, over the number of components, is no more
than their squared distance; a side ends where it strictly exceeds the best distance found. Equal
distances go to the lower index, so an entry that may still tie is looked at.

Codebooks are improved by rounds over all vectors: each task adds up the parts of its rows for every
entry, and the sums of all tasks are added by an aggregation. What reaches the driver is as large as the
codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sipnote.llm.common import maybe_broadcast, settings
from sipnote.session import written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Components are kept within these bounds; below the second, 64 bits hold all distances.
MOST = 2**62
WIDE = 2**20
LONG_MAX = 2**63 - 1
BATCH_BYTES = 4 * 1024 * 1024


def sound(column: str):
    """Condition: not null, and no component null or not finite."""
    x = F.col(column)
    return x.isNotNull() & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)``, within ``MOST``: as int64, or as Python's integers if large."""
    with np.errstate(over="ignore"):
        down = np.clip(np.floor(vectors.astype(np.float64) * SCALE), -float(MOST), float(MOST)).astype(np.int64)
    return down if not down.size or max(abs(int(down.min())), int(down.max())) < WIDE else down.astype(object)


def cut_points(d: int) -> list[int]:
    """Where the parts begin and end; the first are longer by one where they cannot be equal."""
    sizes = [d // PARTS + (i < d % PARTS) for i in range(PARTS)]
    return [sum(sizes[:i]) for i in range(PARTS + 1)]


@dataclass
class Book:
    """The entries of one part, and their order by component sum."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        self.sums = self.entries.sum(axis=1)
        self.order = np.lexsort((np.arange(len(self.sums)), self.sums))
        self.sorted = self.sums[self.order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index and squared distance of each part's nearest entry, and how many distances that took."""
        n, d = parts.shape
        if not d:
            return np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        entries = self.entries if parts.dtype == self.entries.dtype else self.entries.astype(object)
        sums, ordered = parts.sum(axis=1), self.sorted.astype(parts.dtype if parts.dtype == object else self.sorted.dtype)
        at = np.searchsorted(ordered, sums)
        index, best = np.full(n, len(entries)), np.zeros(n, entries.dtype)
        looked = 0
        active = [np.arange(n), np.arange(n)]
        for step in range(len(entries)):
            for side, sign in enumerate((0, -1)):
                rows = active[side]
                place = at[rows] + step if not sign else at[rows] - 1 - step
                inside = (place >= 0) & (place < len(entries))
                rows, place = rows[inside], place[inside]
                gap = ordered[place] - sums[rows]
                going = (index[rows] == len(entries)) | ~(gap * gap > best[rows] * d).astype(bool)
                rows, chosen = rows[going], self.order[place[going]]
                active[side] = rows
                if not len(rows):
                    continue
                apart = parts[rows] - entries[chosen]
                distance = (apart * apart).sum(axis=1)
                looked += len(rows)
                nearer = (index[rows] == len(entries)) | (distance < best[rows]).astype(bool)
                nearer |= (distance == best[rows]).astype(bool) & (chosen < index[rows])
                index[rows[nearer]], best[rows[nearer]] = chosen[nearer], distance[nearer]
            if not len(active[0]) and not len(active[1]):
                break
        return index, best, looked


def _books(codebooks: list[np.ndarray]) -> list[Book]:
    return [Book(c if not c.size or max(abs(int(c.min())), int(c.max())) < WIDE else c.astype(object)) for c in codebooks]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return whole_numbers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d))


def part_sums(rows: DataFrame, d: int, codebooks: list[np.ndarray]) -> list:
    """(part, entry, n, sums) of the parts nearest to each used entry, over all rows."""
    cuts, books = cut_points(d), _books(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(b.entries), np.int64) for b in books]
        sums = [np.zeros(b.entries.shape, object) for b in books]
        for batch in batches:
            x = _matrix(batch.column(0), d)
            for i, book in enumerate(books):
                part = x[:, cuts[i] : cuts[i + 1]]
                index, _, _ = book.nearest(part)
                n[i] += np.bincount(index, minlength=len(n[i]))
                order = np.argsort(index, kind="stable")
                starts = np.flatnonzero(np.diff(index[order], prepend=-1))
                if len(starts) and part.shape[1]:
                    # A batch of small numbers adds up within 64 bits, all batches perhaps not.
                    sums[i][index[order][starts]] += np.add.reduceat(part[order], starts, axis=0).astype(object)
        rows = [(i, e, int(n[i][e]), [str(v) for v in sums[i][e]]) for i in range(PARTS) for e in np.flatnonzero(n[i])]
        columns = list(zip(*rows)) or [()] * 4
        types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "entry", "n", "sums"])

    width = cuts[1]
    added = [F.sum(F.get("sums", F.lit(j)).cast("decimal(38,0)")).alias(f"s{j}") for j in range(width)]
    limits = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    with settings(rows.sparkSession, limits):
        sums = rows.select("embedding").mapInArrow(run, "part int, entry int, n long, sums array<string>")
        return sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect()  # PARTS * ENTRIES rows


def improved(codebooks: list[np.ndarray], sums: list) -> list[np.ndarray]:
    """Every used entry as the floor of its parts' mean; the others stay."""
    out = [c.astype(object) for c in codebooks]
    for part, entry, n, *added in sums:
        size = out[part].shape[1]
        out[part][entry] = [int(s) // n for s in added[:size]]
    return out


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    """Hex digest of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for c in codebooks for v in c.ravel()).encode()).hexdigest()


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> tuple[DataFrame, int]:
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"), label.alias("label"))
    rows = rows.where(sound("embedding"))
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    return rows.where(F.size("embedding") == d), d


def fit_codebooks(rows: DataFrame, d: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part after ``rounds`` rounds, begun with the vectors of the smallest ids."""
    order = [F.asc_nulls_last("vec_id"), F.col("embedding")]
    start = rows.orderBy(*order).limit(entries).select("embedding").collect()
    x = whole_numbers(np.array([r["embedding"] for r in start], dtype=np.float64).reshape(len(start), d))
    cuts = cut_points(d)
    codebooks = [x[:, cuts[i] : cuts[i + 1]] for i in range(PARTS)]
    for _ in range(rounds):
        codebooks = [c.astype(np.int64) for c in improved(codebooks, part_sums(rows, d, codebooks))]
    return codebooks


def encode(rows: DataFrame, d: int, codebooks: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error): a byte for each part, and the squared distance to what it stands for."""
    cuts, books = cut_points(d), _books(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            found = [book.nearest(x[:, cuts[i] : cuts[i + 1]]) for i, book in enumerate(books)]
            codes = np.column_stack([index for index, _, _ in found]).astype(np.uint8)
            errors = sum(best.astype(object) for _, best, _ in found)
            columns = [
                batch.column(0),
                batch.column(2),
                pa.array([c.tobytes() for c in codes], pa.binary()),
                pa.array([min(int(e), LONG_MAX) for e in errors], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    limits = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    with settings(rows.sparkSession, limits):
        return written(rows.mapInArrow(run, f"vec_id long, label {kind}, code binary, error long"), "vector-codes")


def decode(codes: np.ndarray, codebooks: list[np.ndarray]) -> np.ndarray:
    """The whole-number vectors that rows of codes stand for."""
    return np.concatenate([codebooks[i][codes[:, i]] for i in range(PARTS)], axis=1)


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label"
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error, label_error) of every vector, and the codebooks.

    Vectors that are null or hold null or non-finite components are dropped, and so are vectors of
    another size than most have (of equally many, the longer). ``label_error`` adds up the errors of
    equal labels, null ones together. A null id is kept; it comes last where codebooks begin, and rows
    of one id are vectors each, in the order of their components there. With fewer vectors than entries
    the codebooks are smaller. Components beyond 2^62 / 256 count as that; errors beyond a long as the
    largest. An empty table gives no rows, and empty codebooks. Other columns are ignored.
    """
    rows, d = usable(vectors, id_col, vector_col, label_col)
    codebooks = fit_codebooks(rows, d)
    coded = encode(rows, d, codebooks) if len(codebooks[0]) else _nothing(rows)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    labels = written(coded.groupBy("label").agg(total.alias("label_error")), "label-errors")
    labels = maybe_broadcast(labels.withColumnRenamed("label", "_label"), 32)
    return coded.join(labels, F.col("label").eqNullSafe(F.col("_label"))).drop("_label"), codebooks


def _nothing(rows: DataFrame) -> DataFrame:
    empty = rows.where("false")
    return empty.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
