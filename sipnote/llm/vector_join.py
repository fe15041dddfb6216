"""Embeddings linked by their cosine: a subspace pigeonhole join.

Of unit vectors u and v with cosine c, the squared distance is 2 - 2c. Vectors are rotated at random,
which spreads their differences evenly, and cut into blocks of ``BLOCK`` components. If the whole squared
distance is within the budget 2 - 2 * least, then in at least one block it is within that block's
proportional share. So each block is joined by itself, on a range in a space of few dimensions, and no
link is lost; the union of what the blocks find is verified by the exact cosine of the given vectors.

The range join of a block works on tiles. A tree of medians, fitted to a bounded sample, deals all vectors
to leaves; leaves with more than a tile's rows are dealt out to several tiles by a hash, so a hot spot is
many tiles. Tiles carry the box that holds their rows. Tiles whose boxes are within the share of each
other meet by an equi-join on stretches of their first component; each such pair is one row, compared in
memory. A pair of vectors counts in the first block whose share it keeps, so none counts twice.

Disk is bounded by the input, though comparisons are not: blocks are laid out as tiles some at a time, tiles
meet by cells of several tiles on both sides, and cells are shuffled in rounds. Tiles of a block and the
shuffle of a round are deleted once what was found is written.

What leaves a comparison grows with the tiles, not with the pairs found: for each vector the number of
its links, and for each vector one link to its like. Vectors equal in all components are one class first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sipnote.llm.common import maybe_broadcast, settings
from sipnote.llm.graph import components
from sipnote.session import new_path, remove, written

LEAST = 0.9
BLOCK = 16
SEED = 12
# Vectors a tree of medians is fitted to, at most; a leaf has at least so many of them.
SAMPLE, SAMPLE_LEAF = 20_000, 16
TILE_BYTES = 4 * 1024 * 1024
# Tiles that are on disk at once, and copies of them in a round: so many bytes, or a block and so many times a block.
HELD_BYTES, ROUND_BLOCKS = 64 * 1024 * 1024, 4
# Tiles on either side of a cell, if there are enough cells, and cells for each core.
CELL_TILES, CELLS_PER_CORE = 4, 4
# Tasks that share the cells of a round, at most.
TASKS = 20_000
# Shuffle files go once the query that wrote them ends.
NO_SHUFFLE_LEFT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Pairs of vectors compared at once.
STRIP = 1 << 20
GATHERED = 1 << 15
# What rounding may do to a distance in single precision, and in double precision.
COARSE, FINE = 1e-5, 1e-9


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, d]).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def block_cuts(d: int) -> list[tuple[int, int]]:
    """Blocks of ``BLOCK`` components; the last may be shorter."""
    return [(a, min(a + BLOCK, d)) for a in range(0, d, BLOCK)]


def shares(d: int, least: float) -> np.ndarray:
    """Each block's part of the squared distance of linked vectors, by its number of components."""
    return (2 - 2 * least) * np.array([b - a for a, b in block_cuts(d)]) / d


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that squares neither overflow nor vanish."""
    x = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (x, y))
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


@dataclass
class Tree:
    """Splits at medians, one component after the other; leaves are numbered from 0."""

    depth: int
    splits: dict[int, tuple[int, float]]

    @classmethod
    def fit(cls, points: np.ndarray, leaves: int) -> Tree:
        depth = max(0, min(int(np.ceil(np.log2(max(1, leaves)))), int(np.log2(max(1, len(points) // SAMPLE_LEAF)))))
        splits: dict[int, tuple[int, float]] = {}
        held = {1: points}
        for _ in range(depth):
            below = {}
            for node, own in held.items():
                spread = own.var(axis=0) if len(own) else np.zeros(points.shape[1])
                axis = int(spread.argmax())
                value = float(np.median(own[:, axis])) if len(own) else 0.0
                splits[node] = (axis, value)
                high = own[:, axis] > value
                below[2 * node], below[2 * node + 1] = own[~high], own[high]
            held = below
        return cls(depth, splits)

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for level in range(self.depth):
            first = 1 << level
            axis, value = (np.array(v) for v in zip(*(self.splits[k] for k in range(first, 2 * first))))
            at = node - first
            node = 2 * node + (points[np.arange(len(points)), axis[at]] > value[at])
        return node - (1 << self.depth)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)


def vector_classes(rows: DataFrame) -> DataFrame:
    """(class, d, embedding, n, least_id) of the distinct vectors of ``rows`` (vec_id, embedding) that may link, written."""
    x = F.col("embedding")
    finite = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    sound = F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0)
    grouped = rows.where(sound).groupBy("embedding").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least_id"))
    numbered = grouped.withColumn("class", F.monotonically_increasing_id())  # numbers stay as they are written
    return written(numbered.select("class", F.size("embedding").alias("d"), "embedding", "n", "least_id"), "vector-classes")


TILE = "block int, leaf int, chunk int, members long, low array<double>, high array<double>, ids binary, weights binary, vectors binary"


def block_trees(classes: DataFrame, d: int, count: int, seed: int, rows_per_tile: int) -> list[Tree]:
    """A tree for every block, fitted to a sample of bounded size."""
    cuts = block_cuts(d)
    if count <= rows_per_tile:
        return [Tree(0, {})] * len(cuts)
    sample = classes.select("embedding").orderBy(F.xxhash64("class")).limit(max(SAMPLE_LEAF, SAMPLE * 64 // max(d, 64))).toArrow()
    points = unit(_matrix(sample.column(0).combine_chunks(), d)) @ rotation(d, seed)
    return [Tree.fit(points[:, a:b], -(-count // rows_per_tile)) for a, b in cuts]


def tiles(classes: DataFrame, d: int, trees: list[Tree], blocks: range, seed: int, rows_per_tile: int, path: str) -> DataFrame:
    """Packed rows of every leaf of some blocks (``TILE``), with the box they lie in, written to ``path``."""
    spark, turn, cuts = classes.sparkSession, rotation(d, seed), block_cuts(d)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = unit(_matrix(batch.column(2), d))
            for i in blocks:
                leaf = trees[i].leaf(vectors @ turn[:, slice(*cuts[i])])
                columns = [pa.array(np.full(len(leaf), i, np.int32)), pa.array(leaf.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, *batch.columns], ["block", "leaf", "class", "n", "embedding"])

    kind = classes.schema["embedding"].dataType.simpleString()
    own = classes.select("class", "n", "embedding")
    leaves = own.mapInArrow(deal, f"block int, leaf int, class long, n long, embedding {kind}")
    # Leaves are bounded by the sample, so this table is: SAMPLE / SAMPLE_LEAF a block.
    sizes = leaves.groupBy("block", "leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_tile)).alias("chunks"))
    sizes = written(sizes, "vector-leaves")
    dealt = leaves.join(F.broadcast(sizes), ["block", "leaf"])
    dealt = dealt.select("block", "leaf", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int").alias("chunk"), "class", "n", "embedding")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tile(key, held):
            ids, weights, vectors = (np.concatenate(h) for h in zip(*held))
            a, b = cuts[key[0]]
            turned = unit(vectors.astype(np.float64)) @ turn[:, a:b]
            row = (*key, len(ids), turned.min(axis=0).tolist(), turned.max(axis=0).tolist(), ids.tobytes(), weights.tobytes(), vectors.tobytes())
            types = [pa.int32()] * 3 + [pa.int64()] + [pa.list_(pa.float64())] * 2 + [pa.binary()] * 3
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], [c.split()[0] for c in TILE.split(", ")])

        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
            ids, weights = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            vectors = batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for a, b in zip(starts, [*starts[1:], len(keys)]):
                k = tuple(int(v) for v in keys[a])
                if k != key and held:
                    yield tile(key, held)
                    held = []
                key = k
                held.append((ids[a:b], weights[a:b], vectors[a:b]))
        if held:
            yield tile(key, held)

    ordered = dealt.repartition("block", "leaf", "chunk").sortWithinPartitions("block", "leaf", "chunk", "class")
    limits = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows_per_tile),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(TILE_BYTES),
    }
    with settings(spark, limits):
        ordered.mapInArrow(pack, TILE).write.parquet(path)
    return spark.read.schema(TILE).parquet(path).withColumn("tile", F.struct("block", "leaf", "chunk"))


def tile_place() -> Column:
    """Number of a tile in the order of its block's leaves. Tiles are few: a row for ``TILE_BYTES`` of vectors."""
    return F.row_number().over(Window.partitionBy("block").orderBy("leaf", "chunk")) - 1


def near_tiles(packed: DataFrame, d: int, least: float) -> DataFrame:
    """(block, first, second): tiles of a block whose boxes are within its share of each other, written.

    Boxes meet on stretches of their first component; the first stretch that both reach gives the pair. Tiles are
    given by their place in the order of a block's leaves, the first before the second or the same.
    """
    share = F.element_at(F.array(*[F.lit(float(s) + COARSE) for s in shares(d, least)]), F.col("block") + 1)
    width = F.sqrt(share)
    boxes = packed.select("block", tile_place().alias("tile"), "low", "high", share.alias("share"), width.alias("width"))
    from_, to = F.floor(F.col("low")[0] / width), F.floor(F.col("high")[0] / width)
    one = boxes.withColumn("stretch", F.explode(F.sequence(from_, to)))
    other = boxes.select("block", F.col("tile").alias("tile2"), F.col("low").alias("low2"), F.col("high").alias("high2"), "width")
    reach_from, reach_to = F.floor((F.col("low2")[0] - F.col("width")) / F.col("width")), F.floor((F.col("high2")[0] + F.col("width")) / F.col("width"))
    other = other.withColumn("stretch", F.explode(F.sequence(reach_from, reach_to))).drop("width")
    gaps = F.zip_with(
        F.zip_with("low", "high2", lambda a, b: a - b),
        F.zip_with("low2", "high", lambda a, b: a - b),
        lambda p, q: F.greatest(p, q, F.lit(0.0)),
    )
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    first_stretch = F.greatest(F.floor(F.col("low")[0] / F.col("width")), F.floor((F.col("low2")[0] - F.col("width")) / F.col("width")))
    met = one.join(other, ["block", "stretch"]).where((F.col("tile") <= F.col("tile2")) & (F.col("stretch") == first_stretch) & (apart <= F.col("share")))
    return written(met.select("block", F.col("tile").alias("first"), F.col("tile2").alias("second")), "near-tiles")


def cells(pairs: DataFrame, side: int) -> DataFrame:
    """(block, row, column, tile, later, firsts): the tiles of every cell, and those of it that each is compared with.

    A cell holds the pairs of up to ``side`` neighbouring tiles with ``side`` others, or with each other.
    Tiles of ``column`` come ``later``, each to be compared with those of ``row`` as named.
    """
    row, column = (F.floor(F.col(c) / F.lit(side)).cast("int").alias(name) for c, name in (("first", "row"), ("second", "column")))
    own = pairs.select("block", row, column, "first", "second")
    later = own.select("block", "row", "column", F.col("second").alias("tile"), F.col("first"))
    held = own.select("block", "row", "column", F.col("first").alias("tile"), F.lit(None).cast("int").alias("first"))
    both = later.withColumn("later", F.col("row") != F.col("column")).unionByName(held.withColumn("later", F.lit(False)))
    return both.groupBy("block", "row", "column", "tile", "later").agg(F.collect_list("first").alias("firsts"))


class Forest:
    """Groups of linked numbers, joined many at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.parent[a], self.parent[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))
            while ((up := self.parent[self.parent]) != self.parent).any():
                self.parent = up


@dataclass
class Side:
    """A tile in memory: classes, their rows, the vectors, unit vectors and rotated unit vectors."""

    ids: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    turned: np.ndarray
    coarse: np.ndarray

    @classmethod
    def read(cls, ids: bytes, weights: bytes, vectors: bytes, d: int, kind: str, turn: np.ndarray) -> Side:
        x = np.frombuffer(vectors, kind).reshape(-1, d)
        turned = unit(x.astype(np.float64)) @ turn
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(weights, np.int64), x, turned, turned.astype(np.float32))


@dataclass
class Comparison:
    """The links of two tiles that belong to one block."""

    d: int
    least: float
    turn: np.ndarray

    def __post_init__(self) -> None:
        self.cuts, self.shares = block_cuts(self.d), shares(self.d, self.least) + FINE

    def links(self, block: int, one: Side, two: Side, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (in ``one``, in ``two``) of linked vectors, each pair of vectors once over all blocks."""
        a, b = self.cuts[block]
        y = two.coarse[:, a:b]
        y_length = (y * y).sum(axis=1)
        rows = max(1, STRIP // max(1, len(y)))
        for start in range(0, len(one.ids), rows):
            x = one.coarse[start : start + rows, a:b]
            apart = (x * x).sum(axis=1)[:, None] + y_length - 2 * (x @ y.T)
            i, j = np.nonzero(apart <= self.shares[block] + COARSE)
            i += start
            if same:
                i, j = i[i < j], j[i < j]
            for at in range(0, len(i), GATHERED):
                p, q = i[at : at + GATHERED], j[at : at + GATHERED]
                hit = self._hit(block, one, two, p, q)
                if hit.any():
                    yield p[hit], q[hit]

    def _hit(self, block: int, one: Side, two: Side, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the cosines are ``least`` or more, and this block is the first whose share is kept."""
        inner = (one.turned[p] * two.turned[q]).sum(axis=1)
        hit = inner >= self.least - FINE
        p, q = p[hit], q[hit]
        good = inner[hit] >= self.least + FINE
        close = np.flatnonzero(~good)
        if len(close):
            good[close] = cosines(one.vectors[p[close]].astype(np.float64), two.vectors[q[close]].astype(np.float64)) >= self.least
        kept = self._kept(one.turned[p] - two.turned[q], block)
        unsure = np.flatnonzero(kept < 0)
        if len(unsure):
            # At the edge of a share the answer must not depend on how a tile was multiplied.
            x, y = (self._turned_alone(s.vectors[k[unsure]]) for s, k in ((one, p), (two, q)))
            kept[unsure] = self._kept(x - y, block, 0.0)
        hit[hit] = good & (kept == block)
        return hit

    def _kept(self, apart: np.ndarray, block: int, edge: float = FINE / 10) -> np.ndarray:
        """The first block up to ``block`` whose share is kept, or one more than it; -1 where that is a matter of rounding."""
        first = np.full(len(apart), block + 1)
        unsure = np.zeros(len(apart), bool)
        for k in range(block, -1, -1):
            a, b = self.cuts[k]
            distance = (apart[:, a:b] ** 2).sum(axis=1)
            first[distance <= self.shares[k]] = k
            unsure |= np.abs(distance - self.shares[k]) < edge
        first[unsure] = -1
        return first

    def _turned_alone(self, vectors: np.ndarray) -> np.ndarray:
        x = unit(vectors.astype(np.float64))
        out = np.zeros_like(x)
        for k in range(self.d):
            out += x[:, k : k + 1] * self.turn[k]
        return out

    def found(self, block: int, one: Side, two: Side, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, number of links, class of the least place its links reach) of the classes with links."""
        n = len(one.ids)
        shift = 0 if same else n
        ids = one.ids if same else np.concatenate([one.ids, two.ids])
        weights = one.weights if same else np.concatenate([one.weights, two.weights])
        counts, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        for p, q in self.links(block, one, two, same):
            q = q + shift
            counts += np.bincount(p, weights[q], len(ids)).astype(np.int64) + np.bincount(q, weights[p], len(ids)).astype(np.int64)
            forest.join(p, q)
        linked = np.flatnonzero(counts)
        return ids[linked], counts[linked], ids[forest.parent[linked]]


FOUND = "class long, links long, root long"


def compared(packed: DataFrame, pairs: DataFrame, d: int, least: float, seed: int, block_bytes: int, tile_bytes: int, into: str) -> None:
    """Write the ``FOUND`` rows of all pairs of near tiles to ``into``. A task holds one side of a cell at a time.

    A round shuffles ``HELD_BYTES`` or ``ROUND_BLOCKS`` times a block's bytes.
    """
    cores = packed.sparkSession.sparkContext.defaultParallelism
    count, side = pairs.count(), CELL_TILES
    while side > 1 and count < side * side * cores * CELLS_PER_CORE:
        side //= 2
    entries = written(cells(pairs, side), "near-cells")
    rounds = -(-entries.count() * tile_bytes // max(HELD_BYTES, ROUND_BLOCKS * block_bytes))
    places = packed.select("block", tile_place().alias("number"), "tile")
    named = entries.withColumnRenamed("tile", "number").join(places, ["block", "number"])
    named = written(named.select("tile", F.struct("block", "row", "column").alias("cell"), "number", "later", "firsts"), "cell-tiles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(d, seed)
        comparison, at, held = Comparison(d, least, turn), None, {}
        for batch in batches:
            for cell, number, later, firsts, block, *packed_rows, kind in zip(*(c.to_pylist() for c in batch.columns)):
                if cell != at:
                    at, held = cell, {}
                two = Side.read(*packed_rows, d, kind, turn)
                if not later:
                    held[number] = packed_rows
                for first in firsts:
                    one = two if first == number else Side.read(*held[first], d, kind, turn)
                    columns = [pa.array(c, pa.int64()) for c in comparison.found(block, one, two, first == number)]
                    yield pa.RecordBatch.from_arrays(columns, ["class", "links", "root"])

    limits = {"spark.sql.execution.arrow.maxBytesPerBatch": str(TILE_BYTES)}
    with settings(packed.sparkSession, limits):
        for i in range(rounds):
            own = named.where(F.pmod(F.xxhash64("cell"), F.lit(rounds)) == i)
            tasks = max(1, min(own.select("cell").distinct().count(), TASKS))
            rows = packed.join(maybe_broadcast(own, 96), "tile").select("cell", "number", "later", "firsts", "block", "ids", "weights", "vectors", "kind")
            ordered = rows.repartition(tasks, "cell").sortWithinPartitions("cell", "later", "number")
            ordered.mapInArrow(run, FOUND).write.mode("append").parquet(into)


def linked_classes(classes: DataFrame, least: float, seed: int, tile_bytes: int) -> DataFrame:
    """``FOUND`` rows of all classes; vectors of unlike size are not compared."""
    spark = classes.sparkSession
    double = classes.schema["embedding"].dataType.elementType.typeName() == "double"
    into = new_path(spark, "vector-links")
    spark.createDataFrame([], FOUND).write.parquet(into)
    for d, count in classes.groupBy("d").count().orderBy("d").collect():  # a row for each size in use
        own, row_bytes = classes.where(F.col("d") == d), (8 if double else 4) * d
        rows_per_tile = max(64, tile_bytes // row_bytes)
        trees = block_trees(own, d, count, seed, rows_per_tile)
        at_once = max(1, HELD_BYTES // (count * row_bytes))
        for first in range(0, len(trees), at_once):
            blocks, path = range(first, min(first + at_once, len(trees))), new_path(spark, "vector-tiles")
            packed = tiles(own, d, trees, blocks, seed, rows_per_tile, path)
            packed = packed.withColumn("kind", F.lit("f8" if double else "f4"))
            size = -(-count * row_bytes * len(blocks) // max(1, packed.count()))
            compared(packed, near_tiles(packed, d, least), d, least, seed, count * row_bytes, size, into)
            remove(spark, path)
    return spark.read.schema(FOUND).parquet(into)


def linked_vectors(
    vectors: DataFrame,
    least: float = LEAST,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = SEED,
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Two vectors link if their cosine is ``least`` (above -1, at most 1) or more. ``n_links`` counts the
    other rows linked directly, equal vectors too; ``component_id`` is the smallest id that links reach;
    ``kept`` says whether that is the row's own. Null, empty and zero vectors, vectors with null or
    non-finite components, and rows with a null id link with nothing and stay; so do vectors of
    different sizes with each other. Rows that repeat an id are vectors each. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    if rows.schema["embedding"].dataType.elementType.typeName() != "float":
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    with settings(rows.sparkSession, NO_SHUFFLE_LEFT):
        classes = vector_classes(rows)
        found = linked_classes(classes, least, seed, tile_bytes)
        about = _about(classes, found)
    width = classes.agg(F.coalesce(F.max("d"), F.lit(0))).first()[0] * 8 + 64
    about = maybe_broadcast(about, width)
    keyed = rows.withColumn("hash", F.when(F.col("vec_id").isNotNull(), F.xxhash64("embedding")))
    same = (keyed["hash"] == about["hash"]) & (F.col("embedding") == F.col("_embedding"))
    own = F.coalesce("component_id", "vec_id")
    return keyed.join(about, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept")
    )


def _about(classes: DataFrame, found: DataFrame) -> DataFrame:
    """(hash, _embedding, n_links, component_id) of the classes with links or several rows, written."""
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("class").alias("u"), F.col("root").alias("v")))
    groups = written(groups.select(F.col("node").alias("class"), F.col("component").alias("group")), "vector-components")
    facts = classes.join(counts, "class", "left").where("n > 1 OR links IS NOT NULL").join(groups, "class", "left")
    facts = written(facts.withColumn("group", F.coalesce("group", "class")), "vector-facts")
    least_ids = facts.groupBy("group").agg(F.min("least_id").alias("component_id"))
    about = facts.join(least_ids, "group").select(
        F.xxhash64("embedding").alias("hash"),
        F.col("embedding").alias("_embedding"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        "component_id",
    )
    return written(about, "vector-about")
