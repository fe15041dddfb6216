"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector's residual to the mean of all vectors is normalised, rotated by a random orthogonal matrix
and reduced to the signs of its components, packed into bits. With the residual's length and the
inner product of code and rotated residual, kept as scalars, the inner product with any query is
estimated without bias, and its error is bounded: with D dimensions, and f the inner product of the
code and the unit residual, the deviation is below ERROR * sqrt((1 - f^2) / f^2 / (D - 1)) with high
probability. Exact products are computed only for vectors whose upper bound reaches what the 20th
best so far has.

Queries are a stated set, sent to the index in blocks of bounded size; each partition of the index
returns its own best few per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sipnote.llm.common import settings
from sipnote.session import written

SEED = 20_24
# Deviations allowed for; at 3 a bound fails about once in 400 estimates.
ERROR = 3.0
# A block of queries, in double precision, and the index rows looked at together.
BLOCK_BYTES = 16 * 1024 * 1024
BATCH_ROWS = 2048
QUERY_ROWS = 512


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray):
    """Packed codes, lengths of the residuals, and the codes' inner products with unit residuals."""
    rest = vectors - mean
    length = np.linalg.norm(rest, axis=1)
    turned = (rest / np.where(length == 0, 1, length)[:, None]) @ turn.T
    bits = turned > 0
    fit = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(bits, axis=1), length, fit


def signs(codes: np.ndarray, dimensions: int) -> np.ndarray:
    return (np.unpackbits(codes, axis=1, count=dimensions).astype(np.float32) * 2 - 1) / np.sqrt(dimensions)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, embedding) of the rows that take part, and their number of dimensions."""
    x = F.col("embedding")
    sound: Column = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding")).where(
        F.col("vec_id").isNotNull() & x.isNotNull() & sound & F.exists(x, lambda v: v != 0)
    )
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    return rows.where(F.size("embedding") == d), d


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def build_index(vectors: DataFrame, d: int, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """Code and scalars of every vector beside the vector itself, written; and the mean of all."""
    means = vectors.select(F.posexplode("embedding").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("v")).collect()
    mean = np.array([r["v"] for r in sorted(means, key=lambda r: r["i"])])
    turn = rotation(d, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), d)
            codes, length, fit = encode(x, mean, turn)
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array([c.tobytes() for c in codes], pa.binary()),
                pa.array(length),
                pa.array(fit),
                pa.array(x @ mean),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["vec_id", "embedding", "code", "length", "fit", "to_mean"]
            )

    kind = vectors.schema["embedding"].dataType.simpleString()
    schema = f"vec_id long, embedding {kind}, code binary, length double, fit double, to_mean double"
    return written(vectors.mapInArrow(run, schema), "vector-index"), mean


class Search:
    """The best ``k`` of the index rows seen, for a block of queries."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, mean: np.ndarray, turn: np.ndarray, k: int, error: float):
        self.ids, self.queries, self.k = ids, queries, k
        rest = queries - mean
        self.length = np.linalg.norm(rest, axis=1)
        self.turned = ((rest / np.where(self.length == 0, 1, self.length)[:, None]) @ turn.T).astype(np.float32)
        self.shift = queries @ mean - mean @ mean
        self.error = error
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0), np.empty(0, np.int64))] * len(ids)

    def add(self, ids, vectors, codes, length, fit, to_mean) -> None:
        d = vectors.shape[1]
        width = length * self.error * np.sqrt(np.maximum(0, 1 - fit**2) / np.maximum(fit, 1e-6) ** 2 / max(d - 1, 1))
        unit = signs(codes, d) * (length / np.maximum(fit, 1e-6)).astype(np.float32)[:, None]
        for start in range(0, len(self.ids), QUERY_ROWS):
            part = slice(start, start + QUERY_ROWS)
            middle = (self.turned[part] @ unit.T) * self.length[part, None] + to_mean + self.shift[part, None]
            upper = middle + width * self.length[part, None] + 1e-4 * (1 + np.abs(middle))
            first = np.argpartition(-middle, min(self.k, len(ids) - 1), axis=1)[:, : self.k + 1]
            for i in range(len(middle)):
                q = start + i
                scores, names = self._merge(q, first[i], ids, vectors, *self.best[q])
                least = scores[-1] if len(scores) == self.k else -np.inf
                more = np.flatnonzero(upper[i] >= least)
                self.best[q] = self._merge(q, np.setdiff1d(more, first[i]), ids, vectors, scores, names)

    def _merge(self, q: int, rows: np.ndarray, ids, vectors, scores, names):
        rows = rows[ids[rows] != self.ids[q]]
        exact = (vectors[rows] * self.queries[q]).sum(axis=1)
        scores, names = np.concatenate([scores, exact]), np.concatenate([names, ids[rows]])
        order = np.lexsort((names, -scores))[: self.k]
        return scores[order], names[order]

    def rows(self) -> pa.RecordBatch:
        n = [len(s) for s, _ in self.best]
        columns = [
            pa.array(np.repeat(self.ids, n)),
            pa.array(np.concatenate([x for _, x in self.best]) if n else np.empty(0, np.int64)),
            pa.array(np.concatenate([s for s, _ in self.best]) if n else np.empty(0)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def search(index: DataFrame, mean: np.ndarray, queries: DataFrame, d: int, k: int, seed: int, error: float) -> DataFrame:
    """The best ``k`` per query (vec_id, embedding; one row per id), in blocks of queries."""
    turn = rotation(d, seed)
    blocks = max(1, -(-queries.count() * d * 8 // BLOCK_BYTES))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    out = None
    for block in range(blocks):
        # BLOCK_BYTES on average, by a hash of distinct ids.
        given = dealt.where(F.col("block") == block).select("vec_id", "embedding").toArrow().combine_chunks()
        if not given.num_rows:
            continue
        ids = given.column("vec_id").to_numpy()
        vectors = _matrix(given.column("embedding").combine_chunks(), d)
        shared = index.sparkSession.sparkContext.broadcast((ids, vectors))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            here = Search(*shared.value, mean, turn, k, error)
            for batch in batches:
                if batch.num_rows:
                    codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                    scalars = [batch.column(c).to_numpy() for c in (3, 4, 5)]
                    here.add(batch.column(0).to_numpy(), _matrix(batch.column(1), d), codes, *scalars)
            yield here.rows()

        with settings(index.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
            found = written(index.mapInArrow(run, "query_id long, vec_id long, score double"), "neighbours")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return index.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = SEED,
    error: float = ERROR,
) -> DataFrame:
    """The ``k`` rows with the largest inner product for each query: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on ``vec_id``. Rows with a null id, a null, zero or empty vector, or
    null or non-finite components take no part, nor do vectors of another size than most have. Ties
    go to the smaller id. Rows with the query's id are not its candidates; a query id that repeats
    asks once, with the smallest of its vectors; other repeated rows are candidates each. No usable
    rows or queries: an empty result. Other columns are ignored, whatever their names.
    """
    rows, d = usable(vectors, id_col, vector_col)
    if not d:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, mean = build_index(rows, d, seed)
    queries = index.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return search(index, mean, queries, d, k, seed, error)
