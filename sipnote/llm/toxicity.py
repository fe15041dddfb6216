"""Toxic passages by maximum-scoring segments, and a calibrated score per document.

Every word has a score: its log-odds of standing in a toxic document, with an informative Dirichlet
prior, where they are significant, and a small negative drift where not. A linear scan finds all
maximal scoring segments of a text (Ruzzo and Tompa). By extreme-value statistics (Karlin and
Altschul) a text of n words without toxicity holds about K n exp(-lambda S) segments of score S or
more; what a segment's score exceeds that chance by, in nats, is its evidence. A logistic curve of
the evidence, fitted on labelled rows that took no part in the word scores, gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sipnote.llm.common import settings, whole
from sipnote.session import written

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
# About so many labelled rows at most take part in fitting; a hash of the id decides which.
SAMPLE = 60_000
# Weight of the prior, in proportion to the toxic documents.
PRIOR = 0.1
# A word counts as toxic if its log-odds are this high, and this many deviations from none.
LEAST_ODDS = 2.0
LEAST_Z = 4.0
LEAST_DOCS = 4
DRIFT = 0.05
CACHE = 500_000
# Folds of crc32(doc_id) mod 5: 0 is held out, 4 calibrates, the others give the word scores.
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4


def features(word: str) -> list[str]:
    """What is counted for a word: itself (marked at its end) and its longer beginnings."""
    return [word + "$", *[word[:n] for n in PREFIXES if len(word) >= n]]


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def log_odds(y1: np.ndarray, y0: np.ndarray, n1: float, n0: float, share: float = PRIOR):
    """Log-odds ratio of toxic to other documents and its z-score, with a prior in proportion to the
    counts in both together."""
    prior = share * n1
    a = prior * (y1 + y0) / (n1 + n0)
    odds = np.log((y1 + a) / (n1 + prior - y1 - a)) - np.log((y0 + a) / (n0 + prior - y0 - a))
    return odds, odds / np.sqrt(1 / (y1 + a) + 1 / (y0 + a))


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in word positions.

    ``hits`` are the words with positive scores, in order; each word between them costs ``drift``.
    Every segment keeps the place of the last one before with a smaller sum before its start, so a
    search back hops over those it need not look at, and the whole takes time in proportion to the hits.
    """
    found: list[list] = []  # start, end, sum before the start, sum at the end, place to hop to
    total, last = 0.0, 0
    for at, score in hits:
        total -= drift * (at - last)
        new = [at, at + 1, total, total + score]
        total += score
        last = at + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                found.append([*new, j])
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(s, e, r - l) for s, e, l, r, _ in found]


@dataclass
class Model:
    weights: dict[str, float]
    drift: float = DRIFT
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    slope: float = 1.0
    level: float = 0.0
    cache: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def score(self, word: str) -> float:
        """The highest significant log-odds of a word's features, or 0."""
        value = self.cache.get(word)
        if value is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            value = max([self.weights.get(f, 0.0) for f in features(word)])
            self.cache[word] = value
        return value

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of words, and the segments."""
        found, score = words(text), self.score
        hits = [(i, s) for i, w in enumerate(found) if (s := score(w)) > 0]
        return len(found), segments(hits, self.drift)

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
        """The significant segments, with their scores in nats above chance."""
        chance = math.log(max(self.scale * max(n, 1), 1e-9))
        return [(s, e, x) for s, e, score in found if (x := self.rate * score - chance) > 0]

    def probability(self, total: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.slope * math.log1p(total) + self.level))))


def fit_extremes(model: Model, clean: list[tuple[int, list[tuple[int, int, float]]]], hits: Counter) -> None:
    """Set lambda and K from rows without toxicity: ``hits`` counts the positive scores seen there.

    lambda solves E exp(lambda s) = 1 over the word scores; K then matches the number of segments.
    One more hit of the highest weight is added, so that the equation has a solution.
    """
    n = sum(x for x, _ in clean) + 1
    values = np.array([*hits, max(model.weights.values(), default=1.0)])
    p = np.array([*hits.values(), 1.0]) / n
    rest = max(0.0, 1 - p.sum())
    low, high = 0.0, 1.0
    f = lambda t: float((p * np.exp(t * values)).sum() + rest * math.exp(-t * model.drift) - 1)
    while f(high) < 0 and high < 100:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if f(middle) > 0 else (middle, high)
    model.rate = max(high, 1e-3)
    scores = [s for _, found in clean for _, _, s in found]
    floor = float(np.median(scores)) if scores else 0.0
    model.scale = (sum(s >= floor for s in scores) + 1) / (n * math.exp(-model.rate * floor))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level of a logistic curve, by Newton steps with a small ridge."""
    design = np.column_stack([x, np.ones_like(x)])
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        h = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, design.T @ (y - p) - 1e-3 * b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def _fold(column: str):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(FOLDS))


def _sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Labelled rows outside the held-out fold, about ``most`` of them: (text, toxic, fold), written.

    A label given twice counts once, toxic if any says so.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("fold", _fold("doc_id"))
    known = known.where(F.col("fold") != HELD_OUT)
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    # About SAMPLE rows of three numbers.
    rows = docs.join(F.broadcast(known), "doc_id").select("text", F.col("toxic").cast("int"), F.col("fold").cast("int"))
    return written(rows, "toxic-sample")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held = {f for w in set(words(text)) for f in features(w)}
            counts[1 if toxic else 0].update(held)
            counts[1 if toxic else 0][""] += 1
        if len(counts[0]) + len(counts[1]) > 1_000_000:
            yield _counted(counts)
            counts = (Counter(), Counter())
    yield _counted(counts)


def _counted(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    names = list(counts[0] | counts[1])
    columns = [pa.array(names, pa.string())]
    columns += [pa.array([counts[k][f] for f in names], pa.int64()) for k in (1, 0)]
    return pa.RecordBatch.from_arrays(columns, ["feature", "y1", "y0"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the labelled rows of ``docs`` (doc_id, text) outside the held-out fold.

    The driver gets the significant features and the segments of the calibration rows; both are
    bounded by ``sample``. Without toxic or without other rows every text scores the same.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id"), whole("text").alias("text"))
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}):
        rows = _sample(docs, labels, sample)
        rows = rows.repartition(max(1, min(64, rows.count() // 500)))
        counted = written(
            rows.where(F.col("fold") != CALIBRATION)
            .select("text", "toxic")
            .mapInArrow(_count, "feature string, y1 long, y0 long")
            .groupBy("feature")
            .agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")),
            "toxic-features",
        )
        totals = counted.where("feature = ''").collect()
        model = Model({})
        if not totals or not totals[0]["y1"] or not totals[0]["y0"]:
            return model
        n1, n0 = totals[0]["y1"], totals[0]["y0"]
        # A feature has to be as frequent in toxic rows as LEAST_Z asks for, which few are.
        likely = counted.where(
            (F.col("feature") != "") & (F.col("y1") >= LEAST_DOCS) & (F.col("y1") * n0 > 2 * F.col("y0") * n1)
        ).toPandas()
        odds, z = log_odds(likely["y1"].to_numpy(float), likely["y0"].to_numpy(float), n1, n0)
        model.weights = {f: float(w) for f, w, s in zip(likely["feature"], odds, z) if s >= LEAST_Z and w >= LEAST_ODDS}

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                scanned = [model.scan(t) for t in batch.column(0).to_pylist()]
                hits = [[s for w in words(t) if (s := model.score(w)) > 0] for t in batch.column(0).to_pylist()]
                columns = [
                    batch.column(1),
                    pa.array([n for n, _ in scanned], pa.int64()),
                    pa.array([[s for _, _, s in found] for _, found in scanned], pa.list_(pa.float64())),
                    pa.array(hits, pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["toxic", "n", "scores", "hits"])

        calibration = (
            rows.where(F.col("fold") == CALIBRATION)
            .select("text", "toxic")
            .mapInArrow(scan, "toxic int, n long, scores array<double>, hits array<double>")
            .collect()
        )
    clean = [(r["n"], [(0, 0, s) for s in r["scores"]]) for r in calibration if not r["toxic"]]
    fit_extremes(model, clean, Counter(s for r in calibration if not r["toxic"] for s in r["hits"]))
    total = [sum(x for _, _, x in model.evidence(r["n"], [(0, 0, s) for s in r["scores"]])) for r in calibration]
    toxic = np.array([float(bool(r["toxic"])) for r in calibration])
    if calibration and 0 < toxic.sum() < len(toxic):
        model.slope, model.level = fit_logistic(np.log1p(np.array(total)), toxic)
    return model


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text: ``doc_id, score, passages``.

    ``passages`` are the significant segments: first word, word after the last, evidence in nats.
    Null and empty texts have none, and the score of no evidence. Repeated and null ids are scored
    row by row. An empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, passages = [], []
            for text in batch.column(1).to_pylist():
                found = model.evidence(*model.scan(text))
                scores.append(model.probability(sum(x for _, _, x in found)))
                passages.append([{"start": s, "end": e, "evidence": x} for s, e, x in found])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "passages"])

    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, "
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}):
        return written(
            rows.mapInArrow(run, schema + "passages array<struct<start:int,end:int,evidence:double>>"), "toxic-scores"
        )


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Fit on ``labels`` and score ``docs``: ``doc_id, held_out, score, predicted, passages``."""
    scored = score_texts(docs, fit(docs, labels, sample))
    return scored.select(
        "doc_id",
        F.coalesce(_fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
    )
