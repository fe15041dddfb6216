"""Documents linked by the Jaccard similarity of their word shingles: a size-aware heavy-light join.

Equal sets are one class first; what follows works on one set per class.

Light (small) sets list all their subsets of the sizes which a link asks to be shared. Sets with a
common subset of that size are linked, without any further look. Linking all holders of a subset to
the smallest of them loses no component, as what it takes to be linked grows with size.

Heavy (large) sets meet in inverted lists. Shingles are ordered, the rare ones first, by a sketch of
their frequencies; two linked sets share ``SHARED`` of the shingles which come first in each (a
tenth of them and a few more), so only these are listed. Short lists, of ``SHORT`` sets at most, give
their pairs, and pairs that meet in enough of them are intersected. Sets that meet in any longer list
are compared there by size and by the parity of hashed shingles, which bounds the difference of two
sets from below and so drops no link; what passes is intersected. A scan of a long list gives at most
two pairs for each of its sets, to a middle and to the likeliest other. Components of what is thereby
linked are contracted, and the lists scanned once more for sets of different components. Entries that may
still be linked then are settled in the task, by their shingles. So what leaves a list grows with its
entries, not with their pairs. Lists longer than a block are scanned block by block at first. In the second
scan, blocks of the component that most sets of a list belong to meet only the blocks of other sets.

The size from which sets are heavy is where listing subsets starts to cost more than scanning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sipnote.llm.common import maybe_broadcast, settings, whole
from sipnote.llm.graph import components
from sipnote.session import written

WORDS = 3
# Linked if 100 * intersection >= PERCENT * union.
PERCENT = 90
CHUNK = 1 << 20
COUNTERS = 1 << 20
BLOCK = 2000
SHORT = 64
SHARED = 4
# What a scan costs a set beside its entries, in rows: comparing and intersecting.
SCAN_ROWS = 40
BITS = (1024, 8192)
LARGE = 1000

_seed = np.random.default_rng(90)
_BYTES = _seed.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_BASE = 0x5851F42D4C957F2D
_STEPS = _seed.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def needed(a: int, b: int, percent: int) -> int:
    """The least intersection of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def smallest_partner(n: int, percent: int) -> int:
    return max(1, -(-percent * n // 100))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, as many as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK + 4096)
            self.up, self.down = (self._row(b, size) for b in (_BASE, pow(_BASE, -1, 2**64)))
        return self.up[:n], self.down

    def clear(self) -> None:
        """Give the memory back: a worker lives on after its task."""
        self.up = self.down = np.empty(0, np.uint64)

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        row = np.full(n, base, np.uint64)
        row[0] = 1
        return np.multiply.accumulate(row)


POWERS = Powers()


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes.

    Words are what white space (ASCII) separates, with A-Z lower-cased. A word's hash is a
    polynomial of its bytes, taken from running sums over all texts at once.
    """
    data = [t.encode("utf-8", "replace") for t in texts]
    raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = POWERS.get(len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * up)))
    word = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    ends = np.cumsum([len(d) + 1 for d in data])
    last = np.searchsorted(start, ends)
    first = np.concatenate(([0], last[:-1]))

    def combined(count: int, at: np.ndarray | slice, size: int) -> np.ndarray:
        total = np.full(size, count, np.uint64)
        for i in range(count):
            total += word[at.start + i : at.start + i + size] * _STEPS[i]
        return mixed(total)

    full = max(0, len(word) - words + 1)
    every = combined(words, slice(0, full), full)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= words:
            own = np.sort(every[a : b - words + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        else:
            out.append(combined(b - a, slice(a, b), 1) if b > a else np.empty(0, np.uint64))
    return out


def set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _batches(batches: Iterator[pa.RecordBatch], words: int):
    """Ids and shingle sets of batches of (id, text), a chunk at a time."""
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        start, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= CHUNK or i + 1 == len(texts):
                yield ids[start : i + 1], shingle_sets(texts[start : i + 1], words)
                start, held = i + 1, 0
    POWERS.clear()


def summarise(docs: DataFrame, words: int) -> DataFrame:
    """Rows (doc_id, n, set_id) per document, and with null n the counters of each task, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counters = ["doc_id", "n", "set_id", "counters"], np.zeros(COUNTERS, np.int64)
        for ids, sets in _batches(batches, words):
            counters += np.bincount((np.concatenate(sets) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
            n = [len(s) for s in sets]
            keys = [set_id(s) if len(s) else None for s in sets]
            columns = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(n), pa.binary())], names)
        if counters.any():
            one = [pa.nulls(1, pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([*one, pa.array([np.minimum(counters, 65_535).astype("<u2").tobytes()], pa.binary())], names)

    return written(docs.mapInArrow(run, "doc_id long, n long, set_id long, counters binary"), "shingle-sets")


def frequency_classes(rows: DataFrame) -> np.ndarray:
    """For each counter 0, or a class that grows with its excess over chance: a byte each.

    The counters of all tasks are summed slice by slice, so that no task holds them all.
    """
    slices = 64
    width = COUNTERS // slices * 2
    parts = rows.where(F.col("counters").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "counters"
    )
    # F.substring counts bytes of a binary from 1.
    cut = F.substring("counters", F.col("slice") * width + 1, F.lit(width))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = totals.setdefault(k, np.zeros(COUNTERS // slices, np.int64))
                total += np.frombuffer(data, "<u2")
        columns = [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["slice", "total"])

    summed = parts.select("slice", cut.alias("part")).repartition(slices, "slice").mapInArrow(
        add, "slice int, total binary"
    )
    total = np.zeros(COUNTERS, np.int64)
    for r in summed.collect():  # COUNTERS numbers
        total[r["slice"] * (COUNTERS // slices) :][: COUNTERS // slices] = np.frombuffer(r["total"], np.int64)
    middle = float(np.median(total))
    excess = total - middle - 5 * np.sqrt(middle + 1)
    return np.where(excess > 0, 1 + np.log2(np.maximum(excess, 1)), 0).astype(np.uint8)


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The first size that is heavy: subsets are listed below it, where that costs less."""
    best, best_cost, light = 1, None, 0
    scan = lambda n: n - smallest_partner(n, percent) + SHARED + SCAN_ROWS
    heavy = sum(k * scan(n) for n, k in sizes.items())
    for n in range(1, max(sizes, default=0) + 2):
        if best_cost is None or light + heavy < best_cost:
            best, best_cost = n, light + heavy
        lists = sum(comb(n, c) for c in subset_sizes(n, percent))
        if lists > 5000:
            break
        light += sizes.get(n, 0) * lists
        heavy -= sizes.get(n, 0) * scan(n)
    return best


def subset_sizes(n: int, percent: int) -> list[int]:
    partners = range(smallest_partner(n, percent), 100 * n // percent + 1)
    return sorted({c for m in partners if (c := needed(n, m, percent)) <= min(n, m)})


@dataclass
class Lister:
    """Lists the subsets of light sets and the first shingles of heavy ones."""

    words: int
    percent: int
    heavy: int
    classes: np.ndarray

    def first(self, shingles: np.ndarray) -> np.ndarray:
        """The shingles by which a set has to be found, rare ones first."""
        n = len(shingles)
        take = min(n, n - smallest_partner(n, self.percent) + SHARED)
        rank = self.classes[(shingles % np.uint64(COUNTERS)).astype(np.int64)]
        rare = np.flatnonzero(rank == 0)
        if len(rare) >= take:
            return shingles[rare[:take]]
        return shingles[np.lexsort((shingles, rank))[:take]]

    def subsets(self, shingles: np.ndarray) -> Iterator[tuple[int, int]]:
        """(size, hash) of the subsets by which a light set is found; by what is left out."""
        n, parts = len(shingles), mixed(shingles * _STEPS[40])
        total = int(parts.sum(dtype=np.uint64))
        values = [int(p) for p in parts]
        for c in subset_sizes(n, self.percent):
            for out in combinations(values, n - c):
                yield c, (total - sum(out)) % 2**64

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in _batches(batches, self.words):
            keys, owners, sizes, shared = [], [], [], []
            for s in sets:
                n = len(s)
                if not n or (key := set_id(s)) in seen:
                    continue
                seen.add(key)
                if n < self.heavy:
                    for c, h in self.subsets(s):
                        keys.append(np.array([h], np.uint64))
                        owners.append((key, n, 1))
                        shared.append(c)
                if n >= self.heavy or 100 * n >= self.percent * self.heavy:
                    keys.append(self.first(s))
                    owners.append((key, n, len(keys[-1])))
                    shared.append(0)
            if len(seen) > 1_000_000:  # a set listed twice is told apart later
                seen.clear()
            if keys:
                times = [k for _, _, k in owners]
                columns = [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.repeat(np.array([o[0] for o in owners], np.int64), times)),
                    pa.array(np.repeat(np.array([o[1] for o in owners], np.int32), times)),
                    pa.array(np.repeat(np.array(shared, np.int32), times)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "set_id", "n", "shared"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole runs of equal ``key`` (the first column) of sorted batches, many runs at a time."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
        whole_ = table.to_batches()[0]
        keys = whole_.column(0).to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield whole_.slice(0, cut)
        rest = whole_.slice(cut)
    if rest is not None:
        yield rest


LISTED = "key long, set_id long, n int, shared int, other long, other_n int"


@dataclass
class Lists:
    """Sorted entries (key, set_id, n, shared) to pairs of short lists and entries of long ones.

    Lists with one set are dropped, and pairs whose sizes are too far apart for a link of
    ``percent``. Never more than a short list is held back between batches: of a
    list known to be long the last entry, which was given out already.
    """

    percent: int = 0

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = np.empty((0, 4), np.int64), False
        for batch in batches:
            new = np.column_stack([batch.column(i).to_numpy().astype(np.int64) for i in (3, 0, 1, 2)])
            rows = np.concatenate([held, new])
            if not len(rows):
                continue
            rows = rows[np.concatenate(([True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))]
            starts = np.flatnonzero(np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1))))
            sizes = np.diff(np.append(starts, len(rows)))
            long = sizes > SHORT
            long[0] |= known
            ends = len(starts) if long[-1] else len(starts) - 1
            yield from self._out(rows, starts[:ends], sizes[:ends], long[:ends], known)
            held = rows[-1:] if long[-1] else rows[starts[-1] :]
            known = bool(long[-1])
        if len(held) and not known:
            yield from self._out(held, np.zeros(1, int), np.array([len(held)]), np.zeros(1, bool), False)

    def _out(self, rows, starts, sizes, long, first_known: bool) -> Iterator[pa.RecordBatch]:
        """What the given lists make; ``first_known``: the first row was given out before."""
        light = rows[starts, 0] > 0
        entry = np.zeros(len(rows), bool)
        entry[: int(sizes.sum())] = np.repeat(long | (light & (sizes > 1)), sizes)
        if first_known:
            entry[0] = False
        if entry.any():
            shared, key, owner, n = rows[entry].T
            yield self._batch(key, owner, n, shared, None, None)
        short = ~light & ~long & (sizes > 1)
        for size in np.unique(sizes[short]).tolist():
            at = starts[short & (sizes == size)][:, None]
            i, j = np.triu_indices(size, 1)
            a, b = (at + i).ravel(), (at + j).ravel()
            least = -(-self.percent * (rows[a, 3] + rows[b, 3]) // (100 + self.percent))
            near = least <= np.minimum(rows[a, 3], rows[b, 3])
            a, b = rows[a[near]], rows[b[near]]
            yield self._batch(None, a[:, 2], a[:, 3], None, b[:, 2], b[:, 3])

    @staticmethod
    def _batch(key, owner, n, shared, other, other_n) -> pa.RecordBatch:
        size, long, int_ = len(owner), pa.int64(), pa.int32()
        made = lambda x, t: pa.nulls(size, t) if x is None else pa.array(x.astype(t.to_pandas_dtype()), t)
        columns = [made(key, long), made(owner, long), made(n, int_)]
        columns += [made(shared, int_), made(other, long), made(other_n, int_)]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in LISTED.split(", ")])


def shared_lists(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of short lists, entries of long ones and of subsets (``LISTED``), written."""
    ordered = entries.repartition(F.col("key")).sortWithinPartitions("shared", "key", "set_id")
    return written(ordered.mapInArrow(Lists(percent).run, LISTED), "shared-lists")


def bitmaps(shingles: np.ndarray) -> list[bytes | None]:
    """Parities of the shingles by hash, in a small and (for large sets) a large bitmap."""
    out: list[bytes | None] = []
    for bits in BITS:
        if bits > BITS[0] and len(shingles) <= LARGE:
            out.append(None)
        else:
            odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % bits, minlength=bits) & 1
            out.append(np.packbits(odd.astype(np.uint8)).tobytes())
    return out


def load_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(set_id, small, large, shingles) of the documents whose id is in ``wanted`` (doc_id), written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _batches(batches, words):
            maps = [bitmaps(s) for s in sets]
            columns = [
                pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                *[pa.array([m[i] for m in maps], pa.binary()) for i in (0, 1)],
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["set_id", "small", "large", "shingles"])

    rows = docs.join(maybe_broadcast(wanted, 16), "doc_id", "left_semi")
    schema = "set_id long, small binary, large binary, shingles array<long>"
    return written(rows.mapInArrow(run, schema), "list-sets")


class Group:
    """The sets of one list: what bounds their distances, and which are known to be joined."""

    def __init__(self, percent: int, owner, n, label, small: pa.Array, large: pa.Array):
        self.percent, self.owner, self.n, self.label = percent, owner, n, label
        self.small = np.frombuffer(b"".join(small.to_pylist()), np.uint64).reshape(len(n), -1)
        maps = large.to_pylist()
        own = [k for k, m in enumerate(maps) if m is not None]
        self.at = np.full(len(n), -1)
        self.at[own] = np.arange(len(own))
        self.large = np.frombuffer(b"".join(maps[k] for k in own), np.uint64).reshape(len(own), -1) if own else None
        self.order = np.argsort(n, kind="stable")
        self.ends = np.searchsorted(n[self.order], 100 * n[self.order] // percent, side="right")

    def likely(self, i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``others`` that may be linked to ``i``, and by how much less they differ than a link allows."""
        both = self.n[i] + self.n[others]
        least = -(-self.percent * both // (100 + self.percent))
        spare = both - 2 * least - np.bitwise_count(self.small[others] ^ self.small[i]).sum(axis=1).astype(np.int64)
        fit = (least <= np.minimum(self.n[i], self.n[others])) & (spare >= 0)
        if self.at[i] >= 0:
            known = np.flatnonzero(fit & (self.at[others] >= 0))
            apart = np.bitwise_count(self.large[self.at[others[known]]] ^ self.large[self.at[i]]).sum(axis=1)
            spare[known] = (both - 2 * least)[known] - apart.astype(np.int64)
            fit[known] = spare[known] >= 0
        return others[fit], spare[fit]

    def after(self, place: int) -> np.ndarray:
        """The sets after a place in the order of sizes that are not too large for a link, and not yet joined."""
        later = self.order[place + 1 : self.ends[place]]
        return later[self.label[later] != self.label[self.order[place]]]


def _groups(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[tuple[int, Group, pa.RecordBatch]]:
    """The lists of sorted batches of (key, set_id, n, degree, label, small, large, ...)."""
    for batch in _runs(batches):
        key = batch.column(0).to_numpy()
        bounds = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a > 1:
                own = batch.slice(a, b - a)
                owner, n, label = (own.column(i).to_numpy() for i in (1, 2, 4))
                if (label != label[0]).any():
                    yield int(key[a]), Group(percent, owner, n, label, own.column(5), own.column(6)), own


@dataclass
class Scan:
    """Pairs of a list's sets that may be linked and are not joined yet: at most two for each set.

    One set is the middle: that with the highest degree in the label most sets have. It is paired with all
    it may be linked to; every set beside is paired with the likeliest of all. A set that may be linked to
    any is in some pair.
    """

    percent: int

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted batches of lists to (key, a, b)."""
        for key, group, own in _groups(batches, self.percent):
            pairs = self._pairs(group, own.column(3).to_numpy())
            if len(pairs):
                a, b = group.owner[pairs[:, 0]], group.owner[pairs[:, 1]]
                columns = [np.full(len(pairs), key), np.minimum(a, b), np.maximum(a, b)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "a", "b"])

    @staticmethod
    def _pairs(group: Group, degree: np.ndarray) -> np.ndarray:
        size = len(group.n)
        labels, counts = np.unique(group.label, return_counts=True)
        common = np.flatnonzero(group.label == labels[counts.argmax()])
        middle = int(common[np.lexsort((group.owner[common], -degree[common]))[0]])
        others = np.flatnonzero(group.label != group.label[middle])
        around, _ = group.likely(middle, others)
        best, spare = np.full(size, -1), np.full(size, -1, np.int64)
        for place in range(size):
            i = int(group.order[place])
            found, room = group.likely(i, group.after(place))
            if not len(found):
                continue
            nearer = room > spare[found]
            best[found[nearer]], spare[found[nearer]] = i, room[nearer]
            if room.max() > spare[i]:
                best[i], spare[i] = found[room.argmax()], room.max()
        rest = np.setdiff1d(np.flatnonzero(best >= 0), around)
        pairs = np.concatenate([np.column_stack([np.full(len(around), middle), around]), np.column_stack([rest, best[rest]])])
        return pairs[np.unique(np.sort(pairs, axis=1), axis=0, return_index=True)[1]] if len(pairs) else pairs


@dataclass
class Settle:
    """Links between sets of a list that join what is not joined yet, by their shingles: fewer than sets."""

    percent: int

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted batches of lists, with the shingles as column 7, to (a, b)."""
        for _, group, own in _groups(batches, self.percent):
            shingles = [np.sort(own.column(7)[i].values.to_numpy()) for i in range(len(group.n))]
            group.label = group.label.copy()
            links = []
            for place in range(len(group.n)):
                i = int(group.order[place])
                for j in group.likely(i, group.after(place))[0].tolist():
                    if group.label[i] == group.label[j]:
                        continue
                    shared = len(np.intersect1d(shingles[i], shingles[j], assume_unique=True))
                    if 100 * shared >= self.percent * (len(shingles[i]) + len(shingles[j]) - shared):
                        links.append((group.owner[i], group.owner[j]))
                        group.label[group.label == group.label[j]] = group.label[i]
            columns = [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by their intersection."""
    pairs = written(pairs.distinct(), "likely-pairs")
    ids = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()
    sets = sets.join(maybe_broadcast(ids, 16), "set_id", "left_semi")
    one = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    return pairs.join(one, "a").join(two, "b").where(100 * shared >= percent * union).select("a", "b")


def _described(by_set: DataFrame, sets: DataFrame, labels: DataFrame | None, *more: str) -> DataFrame:
    """Entries (key, set_id, n) of long lists, with what a scan compares.

    ``by_set`` has a row for each set with the keys of its lists, and so has each join.
    """
    about = sets.select("set_id", "small", "large", *more).join(by_set, "set_id")
    # The set that stands in most lists is the likeliest middle of its like.
    size, degree = F.col("n").cast("long").alias("n"), F.size("keys").cast("long").alias("degree")
    about = _labelled(about, labels)
    return about.select(F.explode("keys").alias("key"), "set_id", size, degree, "label", "small", "large", *more)


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("set_id"))
    return rows.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))


def _in_runs(entries: DataFrame) -> DataFrame:
    return entries.repartition(F.col("key")).sortWithinPartitions("key", "set_id")


def _own_blocks(entries: DataFrame, long: DataFrame) -> DataFrame:
    """Entries of the lists ``long`` (key, blocks) under a key for one block of their list."""
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks"))
    rows = entries.join(maybe_broadcast(long, 16), "key", "left")
    key = F.when(F.col("blocks").isNull(), F.col("key")).otherwise(F.xxhash64("key", block))
    return rows.withColumn("key", key).drop("blocks")


def open_lists(by_set: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, common, commons, others), written, of the lists whose sets are not all joined: the label most sets
    have, and the blocks of the sets with it and of all others."""
    entries = _labelled(by_set, labels).select(F.explode("keys").alias("key"), "label")
    found = entries.groupBy("key", "label").agg(F.count(F.lit(1)).alias("sets"))
    lists = found.groupBy("key").agg(
        F.max_by("label", "sets").alias("common"), F.max("sets").alias("most"), F.sum("sets").alias("all")
    )
    blocks = lambda n: F.ceil(n / BLOCK).cast("long")
    commons, others = blocks(F.col("most")).alias("commons"), blocks(F.col("all") - F.col("most")).alias("others")
    return written(lists.where(F.col("most") < F.col("all")).select("key", "common", commons, others), "open-lists")


def _met_blocks(entries: DataFrame, lists: DataFrame) -> DataFrame:
    """Entries of the ``lists`` that :func:`open_lists` gives, under keys for pairs of blocks.

    Sets with the common label are joined already, so their blocks meet those of the others and not one
    another: a list of one family, with few sets beside, gives as many entries as it has.
    """
    rows = entries.join(maybe_broadcast(lists, 40), "key")
    is_common = F.col("label") == F.col("common")
    own = F.pmod(F.xxhash64("set_id"), F.when(is_common, F.col("commons")).otherwise(F.col("others")))
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    pair = lambda kind, a, b: F.xxhash64("key", F.lit(kind), a, b)
    beside = F.transform(F.filter(upto("others"), lambda k: k != own), lambda k: pair(1, F.least(own, k), F.greatest(own, k)))
    keys = (
        F.when((F.col("commons") == 1) & (F.col("others") == 1), F.array("key"))
        .when(is_common, F.transform(upto("others"), lambda k: pair(0, own, k)))
        .otherwise(F.concat(F.transform(upto("commons"), lambda k: pair(0, k, own)), beside))
    )
    return rows.select(F.explode(keys).alias("key"), *[c for c in entries.columns if c != "key"])


def _labels(links: DataFrame) -> DataFrame:
    """(set_id, label): the component of each linked set, written."""
    found = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return written(found.select(F.col("node").alias("set_id"), F.col("component").alias("label")), "labels")


def scanned_links(met: DataFrame, lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b), written, that join all sets joined by pairs ``met`` or by the long ``lists``.

    Two scans link most sets through few pairs: the first within blocks of a list, the second between all
    sets that are not joined by then. What may still be linked, and is not joined, is in a pair of the second
    scan, list by list; those entries alone get their shingles, and are settled in the task.
    """
    scan = Scan(percent)
    pairs_of = lambda entries: written(_in_runs(entries).mapInArrow(scan.run, "key long, a long, b long"), "scanned")
    by_set = lists.groupBy("set_id").agg(F.first("n").alias("n"), F.collect_list("key").alias("keys"))
    by_set = written(by_set, "long-entries")
    sizes = lists.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    long = written(sizes.where("blocks > 1"), "long-lists")
    in_one = long.isEmpty()
    entries = _described(by_set, sets, None)
    first = pairs_of(entries if in_one else _own_blocks(entries, long))
    links = written(_verified(met.unionByName(first.select("a", "b")), sets, percent), "scan-links")
    if in_one and first.isEmpty():
        return links
    labels = _labels(links)
    again = pairs_of(_met_blocks(_described(by_set, sets, labels), open_lists(by_set, labels)))
    if again.isEmpty():
        return links
    links = written(links.unionByName(_verified(again.select("a", "b"), sets, percent)), "scan-links")
    labels = _labels(links)
    pairs = again.select("key", F.explode(F.array("a", "b")).alias("set_id"))
    pairs = written(pairs.groupBy("set_id").agg(F.collect_set("key").alias("keys")), "open-entries")
    named = _labelled(pairs, labels).select("set_id", F.explode("keys").alias("key"), "label")
    # Lists whose sets are all joined by now are done.
    open_ = named.groupBy("key").agg((F.min("label") < F.max("label")).alias("open")).where("open").select("key")
    open_ = written(open_, "open-keys")
    if open_.isEmpty():
        return links
    own = named.join(maybe_broadcast(open_, 8), "key", "left_semi").groupBy("set_id").agg(F.collect_list("key").alias("keys"))
    own = own.join(by_set.select("set_id", "n"), "set_id")
    rest = _in_runs(_described(own, sets, labels, "shingles")).mapInArrow(Settle(percent).run, "a long, b long")
    return written(links.unionByName(rest.distinct()), "scan-links")


def similar_sets(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Per row (doc_id, n, set_id), and links (a, b) between set ids which join every component."""
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}):
        rows = summarise(docs, words)
        classes = frequency_classes(rows)
        rows = rows.where(F.col("n").isNotNull()).drop("counters")
        ids = rows.where(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull())
        reps = written(ids.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), "set-classes")
        few = reps.where("n < 200").groupBy("n").count().collect()  # at most 200
        heavy = boundary({r["n"]: r["count"] for r in few}, percent)
        lister = Lister(words, percent, heavy, classes)
        # A set of rows without an id stands for no document; others must not be linked through it.
        entries = docs.where("doc_id IS NOT NULL").mapInArrow(lister.run, "key long, set_id long, n int, shared int")
        lists = shared_lists(entries, percent)

    light = lists.where("shared > 0")
    least = light.groupBy("key", "shared").agg(F.min(F.struct("n", "set_id")).alias("least"))
    by_subset = (
        light.join(least, ["key", "shared"])
        .where((F.col("set_id") != F.col("least.set_id")) & (F.col("shared") >= _asked("n", "least.n", percent)))
        .select(F.col("least.set_id").alias("a"), F.col("set_id").alias("b"))
    )

    pair = [F.least("set_id", "other").alias("a"), F.greatest("set_id", "other").alias("b")]
    asked = _asked("n", "other_n", percent)
    met = written(
        lists.where("key IS NULL")
        .select(*pair, F.least(F.lit(SHARED), asked).alias("asked"))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("met"), F.max("asked").alias("asked"))
        .where("met >= asked")
        .select("a", "b"),
        "met-pairs",
    )
    scanned = lists.where("shared = 0")
    either = met.select(F.col("a").alias("set_id")).unionByName(met.select(F.col("b").alias("set_id")))
    wanted = either.unionByName(scanned.select("set_id")).distinct().join(reps, "set_id").select("doc_id")
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}):
        sets = load_sets(docs, wanted, words)
        rest = scanned_links(met, scanned, sets, percent)
    return rows, written(by_subset.unionByName(rest).distinct(), "set-links")


def _asked(n: str, other: str, percent: int) -> Column:
    """The least intersection of linked sets, as :func:`needed`."""
    return F.ceil(F.lit(percent) * (F.col(n) + F.col(other)) / F.lit(100 + percent))


def linked_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n, set_id, group (null without a known
    set; the smallest set of the component) and component_id (the smallest id of the group)."""
    sets, links = similar_sets(docs, words, percent)
    known = sets.where(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull())
    reps = written(known.groupBy("set_id").agg(F.min("doc_id").alias("rep")), "set-representatives")
    # Sets are the nodes: an id that repeats may stand for sets of several components.
    found = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    found = written(found.select(F.col("node").alias("set_id"), F.col("component").alias("group")), "set-components")
    least = found.join(reps, "set_id").groupBy("group").agg(F.min("rep").alias("least"))
    joined = reps.join(maybe_broadcast(found.join(least, "group"), 32), "set_id", "left")
    labels = joined.select(
        "set_id", F.coalesce("group", "set_id").alias("group"), F.coalesce("least", "rep").alias("component_id")
    )
    return sets.join(labels, "set_id", "left").select("doc_id", "n", "set_id", "group", "component_id")


def linked_documents(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    Documents are linked if the Jaccard similarity of their sets of word shingles is ``percent`` or
    more; the component is the smallest id that links reach, through whole chains. A text with
    fewer words than a shingle is one shingle as a whole; null, empty and blank texts have none and
    are linked with nothing, not even each other. Rows with a null id link nothing and have a null
    component. Rows that repeat an id are documents each. An empty table gives an empty result;
    other columns are ignored, whatever their names. Sets are told apart by 64-bit hashes.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    out = linked_rows(rows, words, percent)
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def without_near_copies(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, one for every component: that with the smallest id.

    Rows that repeat an id are documents each, so one may stay and another go. Where several rows of
    a component have its smallest id, one of those with the smallest set id stays, by text. Rows with
    a null id, and texts without shingles, are linked with nothing and stay.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    rows = written(linked_rows(texts, words, percent).where("doc_id IS NOT NULL"), "near-rows")
    dropped = rows.where("component_id <> doc_id").select("doc_id").distinct()
    dropped = maybe_broadcast(written(dropped, "near-copies"), 16)
    again = written(rows.groupBy("doc_id").count().where("count > 1").select("doc_id"), "near-repeated")
    if again.isEmpty():
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    again = maybe_broadcast(again, 16)
    once = docs.join(again, "doc_id", "left_anti").join(dropped, "doc_id", "left_anti").select(*docs.columns)

    # Of ids that repeat, what stays is told by the id and the set.
    first = rows.where("doc_id = component_id").groupBy("group", "doc_id").agg(F.min("set_id").alias("set_id"))
    first = first.where("group IS NOT NULL").join(again, "doc_id", "left_semi").select("doc_id", "set_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), words) if batch.num_rows else []
            ids = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], ["doc_id", "text", "row", "set_id"])

    repeated = docs.join(again, "doc_id", "left_semi").select(*docs.columns)
    keyed = repeated.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"), F.struct("*").alias("row")
    )
    schema = T.StructType([*keyed.schema.fields, T.StructField("set_id", T.LongType())])
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}):
        keyed = written(keyed.mapInArrow(run, schema), "near-keyed")
    chosen = keyed.join(maybe_broadcast(first, 32), ["doc_id", "set_id"], "left_semi")
    chosen = chosen.groupBy("doc_id", "set_id").agg(F.min_by("row", "text").alias("row"))
    blank = keyed.where("set_id IS NULL")
    return once.unionByName(chosen.select("row.*")).unionByName(blank.select("row.*"))
