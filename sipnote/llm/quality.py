"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's n-grams are of UTF-8 bytes, so that its alphabet is closed and one model serves all
languages. Counts, continuation counts, discounts, context weights and interpolated probabilities
are DataFrame aggregations and joins, sharded by n-gram. The finished model is cut into shards of
bounded size by the two bytes before the predicted one, which all n-grams and contexts of three
bytes and more that a prediction may need have in common; each task scores its texts with one shard
after the other. Unigrams and bigrams, at most 65,536, are in every shard.

A document is rejected if its nats per byte are above a threshold of its language and its size
band: the median of trusted documents plus a margin of their high quantile. A band with few trusted
documents takes its threshold from as many bands around it as hold enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sipnote.llm.common import maybe_broadcast, settings, whole
from sipnote.session import written

ORDER = 5
# N-grams and contexts in a shard of the model; a class of two bytes is not cut further.
SHARD_ENTRIES = 2_000_000
# Bytes of text whose n-grams are held at once, and that are scored per reading of a shard.
CHUNK_BYTES = 2 * 1024 * 1024
BUFFER_BYTES = 48 * 1024 * 1024
QUANTILE, MARGIN = 0.995, 2.0
# Trusted documents that a band needs for a threshold of its own.
LEAST_TRUSTED = 100
# A band is a factor of 4 in bytes; no text has more than 2**31.
BANDS = 16
EMPTY = np.uint64(2**64 - 1)
FACTOR = np.uint64(0x9E3779B97F4A7C15)  # multiplicative hashing by the golden ratio


def mask(order: int) -> int:
    return (1 << (8 * order)) - 1


def windows(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all windows of ``order`` bytes over the texts, each with zero bytes before and one
    after, and the bounds (first, past the last) of each text's windows."""
    data = [t.encode("utf-8", "replace") for t in texts]
    size = np.array([len(d) + 1 for d in data], dtype=np.int64)
    block = size + order - 1
    first = np.cumsum(block) - block
    pad = b"\0" * (order - 1)
    raw = np.frombuffer(b"".join([pad + d + b"\0" for d in data]) + pad, np.uint8)
    n = len(raw) - order + 1
    codes = raw[:n].astype(np.int64)
    for i in range(1, order):
        codes <<= 8
        codes |= raw[i : i + n]
    return codes, np.column_stack([first, first + size])


def chunks(texts: list[str], most: int = CHUNK_BYTES) -> Iterator[list[str]]:
    chunk, held = [], 0
    for t in texts:
        chunk.append(t)
        held += len(t)
        if held >= most:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def count_ngrams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n) over the texts of a one-column table, written; counted in the tasks first."""

    def merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
        grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        for batch in batches:
            for chunk in chunks(batch.column(0).to_pylist()):
                codes, bounds = windows(chunk, order)
                keep = np.zeros(len(codes) + 1, np.int8)
                keep[bounds[:, 0]] += 1
                keep[bounds[:, 1]] -= 1
                parts.append(np.unique(codes[np.cumsum(keep[:-1]) > 0], return_counts=True))
                if sum(len(g) for g, _ in parts) > 3_000_000:
                    parts = [merge(parts)]
                    if len(parts[0][0]) > 1_500_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts.pop()], ["gram", "n"])
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merge(parts)], ["gram", "n"])

    with settings(texts.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}):
        counted = texts.mapInArrow(run, "gram long, n long")
        return written(counted.groupBy("gram").agg(F.sum("n").alias("n")), "ngram-counts")


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more."""
    if not n1 or not n2:
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    d1, d2 = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(min(max(d, 0.01), top) for d, top in ((d1, 1.0), (d2, 2.0), (d3, 3.0)))


def estimate(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(kind, order, key, value): log-probabilities of n-grams ('gram') and log-weights that their
    contexts ('context') give to the next lower order; written."""
    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        # The continuation count: with how many different bytes before it the shorter one occurs.
        shorter = F.col("gram").bitwiseAND(F.lit(mask(k)).cast("long")).alias("gram")
        tables[k] = written(
            tables[k + 1].select(shorter).groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "ngram-continuations"
        )
    out, lower = None, None
    for k in range(1, order + 1):
        grams = tables[k]
        few = [F.count(F.when(F.col("n") == i, 1)) for i in (1, 2, 3, 4)]
        d = discounts(*grams.agg(*few).first())
        taken = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        keyed = grams.select("gram", "n", F.shiftright("gram", 8).alias("context"), taken.alias("taken"))
        contexts = keyed.groupBy("context").agg(F.sum("n").alias("total"), F.sum("taken").alias("free"))
        joined = keyed.join(contexts, "context")
        if lower is None:
            below = F.lit(1 / 256)
        else:
            shorter = F.col("gram").bitwiseAND(F.lit(mask(k - 1)).cast("long"))
            joined = joined.withColumn("shorter", shorter).join(
                lower.select(F.col("gram").alias("shorter"), F.col("p").alias("below")), "shorter"
            )
            below = F.col("below")
        p = (F.col("n") - F.col("taken")) / F.col("total") + F.col("free") / F.col("total") * below
        lower = written(joined.select("gram", p.alias("p")), "ngram-probabilities")
        both = lower.select(
            F.lit("gram").alias("kind"), F.lit(k).alias("order"), F.col("gram").alias("key"), F.log("p").alias("value")
        ).unionByName(
            contexts.select(
                F.lit("context").alias("kind"),
                F.lit(k).alias("order"),
                F.col("context").alias("key"),
                F.log(F.col("free") / F.col("total")).alias("value"),
            )
        )
        out = both if out is None else out.unionByName(both)
    return written(out, "ngram-model")


class Table:
    """Open addressing over 64-bit keys, built and searched many keys at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, EMPTY)
        self.values = np.zeros(1 << self.bits, np.float32)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] == EMPTY
            self.keys[at[left[free]]] = keys[left[free]]
            done = self.keys[at[left]] == keys[left]
            self.values[at[left[done]]] = values[left[done]]
            left = left[~done]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where there is none), and which keys are there."""
        at = self._home(keys)
        there = self.keys[at]
        found = there == keys
        out = self.values[at] * found
        left = np.flatnonzero(~found & (there != EMPTY))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            there = self.keys[at[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            found[left[hit]] = True
            left = left[~hit & (there != EMPTY)]
        return out, found


def tagged(keys: np.ndarray, order: int | np.ndarray) -> np.ndarray:
    return keys.astype(np.uint64) | (np.asarray(order).astype(np.uint64) << np.uint64(56))


@dataclass
class Shard:
    """What is needed to predict a byte after the classes (two bytes) for which ``mine`` is true."""

    order: int
    grams: Table
    contexts: Table
    bigrams: np.ndarray  # log-probability of the second byte after the first, all 65,536
    mine: np.ndarray | None

    def totals(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sum of the log-probabilities that this shard predicts, per text."""
        left = None
        if self.mine is not None:
            left = np.flatnonzero(self.mine[(codes >> 8) & 0xFFFF])
        keys = codes if left is None else codes[left]
        total = np.zeros(len(keys), np.float32)
        open_ = np.arange(len(keys))
        for k in range(self.order, 2, -1):
            here = keys[open_] & mask(k)
            value, found = self.grams.find(tagged(here, k))
            total[open_] += value
            open_ = open_[~found]
            if not len(open_):
                break
            total[open_] += self.contexts.find(tagged(here[~found] >> 8, k))[0]
        total[open_] += self.bigrams[keys[open_] & 0xFFFF]
        if left is not None:
            full = np.zeros(len(codes), np.float32)
            full[left] = total
            total = full
        return np.add.reduceat(np.append(total, np.float32(0)).astype(np.float64), bounds.ravel())[::2]


def bigram_table(model: DataFrame) -> np.ndarray:
    """Log-probabilities of all pairs of bytes, from the two lowest orders."""
    rows = model.where(F.col("order") <= 2).collect()  # at most 65,536 + 512
    get = lambda kind, k: {r["key"]: r["value"] for r in rows if r["kind"] == kind and r["order"] == k}
    one = np.full(256, get("context", 1).get(0, 0.0) - math.log(256))
    for key, value in get("gram", 1).items():
        one[key] = value
    two = np.tile(one, (256, 1))
    for key, value in get("context", 2).items():
        two[key] += value
    two = two.ravel()
    for key, value in get("gram", 2).items():
        two[key] = value
    return two.astype(np.float32)


def model_shards(model: DataFrame, order: int = ORDER, entries: int = SHARD_ENTRIES) -> list[Shard]:
    """The model in shards; a shard passes through the driver, one at a time, to be broadcast."""
    high = model.where(F.col("order") > 2)
    two = F.when(F.col("kind") == "gram", F.shiftright("key", 8)).otherwise(F.col("key"))
    high = high.withColumn("class", two.bitwiseAND(F.lit(0xFFFF).cast("long")).cast("int"))
    sizes = sorted((r["class"], r["count"]) for r in high.groupBy("class").count().collect())  # at most 65,536
    bigrams, groups, held = bigram_table(model), [[]], 0
    for c, n in sizes:
        if held and held + n > entries:
            groups.append([])
            held = 0
        groups[-1].append(c)
        held += n
    shards = []
    for group in groups:
        part = high if len(groups) == 1 else high.where(F.col("class").between(group[0], group[-1]))
        rows = part.select((F.col("kind") == "gram").alias("gram"), "order", "key", "value").toArrow()
        is_gram = rows.column("gram").to_numpy()
        keys = tagged(rows.column("key").to_numpy(), rows.column("order").to_numpy())
        values = rows.column("value").to_numpy()
        mine = None
        if len(groups) > 1:
            mine = np.zeros(65_536, bool)
            low = 0 if group is groups[0] else group[0]
            top = 65_535 if group is groups[-1] else groups[groups.index(group) + 1][0] - 1
            mine[low : top + 1] = True
        tables = [Table(keys[x], values[x]) for x in (is_gram, ~is_gram)]
        shards.append(Shard(order, *tables, bigrams, mine))
    return shards


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def score(docs: DataFrame, model: DataFrame, keep: list[str], order: int = ORDER, entries: int = SHARD_ENTRIES):
    """The columns ``keep`` of ``docs`` and two more, written: nats per byte and bytes; with their names."""
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(s) for s in model_shards(model, order, entries)]
    nats, size = _free(docs, "nats_per_byte"), _free(docs, "text_bytes")
    rows = docs.select(*keep, whole("text").alias(_free(docs, "whole_text")))

    def totals(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        total, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for s in shared:
            done = 0
            for chunk in chunks(texts):
                codes, bounds = windows(chunk, order)
                total[done : done + len(chunk)] += s.value.totals(codes, bounds)
                n[done : done + len(chunk)] = bounds[:, 1] - bounds[:, 0]
                done += len(chunk)
            if len(shared) > 1:
                # A worker keeps a broadcast's value once read; the next shard takes its place.
                s.__dict__.pop("_value", None)
        return total, n

    def scored(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for b in held for t in b.columns[-1].to_pylist()]
        total, n = totals(texts)
        done = 0
        for b in held:
            part = slice(done, done + b.num_rows)
            columns = [*b.columns[:-1], pa.array(-total[part] / n[part]), pa.array(n[part] - 1)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, nats, size])
            done += b.num_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bytes_ = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            bytes_ += batch.columns[-1].nbytes
            if len(shared) == 1 or bytes_ >= BUFFER_BYTES:
                yield from scored(held)
                held, bytes_ = [], 0
        if held:
            yield from scored(held)

    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField(nats, T.DoubleType()), T.StructField(size, T.LongType())])
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}):
        out = written(rows.mapInArrow(run, schema), "quality-scores")
    for s in shared:
        s.destroy()
    return out, nats, size


def wider(counts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """For bands with too few trusted documents, the first and last of the bands around them, as near
    as can be, that hold enough; all bands if there are not enough at all."""
    out = {}
    for band in range(BANDS):
        reach, held = 0, counts.get(band, 0)
        while held < LEAST_TRUSTED and reach < BANDS:
            reach += 1
            held = sum(n for b, n in counts.items() if abs(b - band) <= reach)
        if reach:
            out[band] = (band - reach, band + reach)
    return out


def thresholds(scored: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """(lang, band, threshold) from trusted rows (lang, band, nats); a null lang stands for all, and
    has a threshold in every band unless there are no rows."""

    def point(nats: Column) -> Column:
        return F.percentile_approx(nats, F.array(F.lit(0.5), F.lit(quantile)), F.lit(10_000))

    threshold = (F.col("q")[0] + margin * (F.col("q")[1] - F.col("q")[0])).alias("threshold")
    by = lambda *keys: (
        scored.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), point(F.col("nats")).alias("q"))
        .where(F.col("n") >= LEAST_TRUSTED)
    )
    every = F.lit(None).cast("string").alias("lang")
    counts = {r["band"]: r["count"] for r in scored.groupBy("band").count().collect()}  # at most BANDS
    ranges = [
        F.struct(
            F.lit(band).cast("long").alias("band"), point(F.when(F.col("band").between(*ends), F.col("nats"))).alias("q")
        )
        for band, ends in wider(counts).items()
    ]
    out = by("lang", "band").where(F.col("lang").isNotNull()).select("lang", "band", threshold)
    out = out.unionByName(by("band").select(every, "band", threshold))
    if ranges:
        around = scored.agg(F.array(*ranges).alias("ranges")).select(F.inline("ranges")).where("q IS NOT NULL")
        out = out.unionByName(around.select(every, "band", threshold))
    return out


def classify(
    docs: DataFrame,
    labels: DataFrame,
    keep: list[str] | None = None,
    order: int = ORDER,
    entries: int = SHARD_ENTRIES,
) -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` of ``docs`` (all, if not given; doc_id and lang among them) and, under free
    names: nats per byte, threshold, kept. With these names.

    Trusted text is that of rows labelled with quality 1 (at least once, if ids repeat); all of it
    trains the model, and all of it sets the thresholds. Thresholds are those of the language and
    the size band (a factor of 4 in bytes), or of the band over all languages where a language has
    fewer than 100 trusted documents in it. Where these are fewer than 100 too, they are those of the
    band and the nearest bands on both sides that hold 100 together with it, or of all trusted
    documents if there are no 100: every text is judged, whatever its size. Only null and empty texts
    are kept unseen, and all documents where no text is trusted. Rows are judged one by one, with
    repeated or null ids too; an empty table gives an empty result.
    """
    keep = keep or docs.columns
    names = [_free(docs, n) for n in ("nats_per_byte", "threshold", "kept")]
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("trusted_id")).distinct()
    trusted = maybe_broadcast(trusted, 16)
    same = docs["doc_id"] == F.col("trusted_id")
    counts = count_ngrams(docs.join(trusted, same, "left_semi").select(whole("text").alias("text")), order)
    if counts.isEmpty():
        none = F.lit(None).cast("double")
        return docs.select(*keep, *[c.alias(n) for n, c in zip(names, (none, none, F.lit(True)))]), names
    scored, nats, size = score(docs, estimate(counts, order), keep, order, entries)
    band = F.floor(F.log2(F.col(size) + 1) / 2)
    known = scored.where(F.col(size) > 0).join(trusted, scored["doc_id"] == F.col("trusted_id"), "left_semi")
    limits = written(
        thresholds(known.select(F.col("lang"), band.alias("band"), F.col(nats).alias("nats"))), "quality-thresholds"
    )
    own = limits.where("lang IS NOT NULL").select(
        F.col("lang").alias("own_lang"), F.col("band").alias("own_band"), F.col("threshold").alias("own_threshold")
    )
    common = limits.where("lang IS NULL").select(
        F.col("band").alias("common_band"), F.col("threshold").alias("common_threshold")
    )
    limit = F.coalesce("own_threshold", "common_threshold")
    kept = F.coalesce(F.col(size) == 0, F.lit(False)) | F.coalesce(F.col(nats) <= limit, F.lit(True))
    judged = scored.join(
        maybe_broadcast(own, 64), (scored["lang"] == F.col("own_lang")) & (band == F.col("own_band")), "left"
    ).join(F.broadcast(common), band == F.col("common_band"), "left")  # at most BANDS rows
    return (
        judged.select(
            *keep, F.col(nats).alias(names[0]), limit.alias(names[1]), kept.alias(names[2])
        ),
        names,
    )
