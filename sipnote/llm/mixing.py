"""Mixing documents to target weights of domains, with soft membership; DataFrame functions alone.

A naive Bayes classifier over hashed words, trained on a labelled table, gives each document a
posterior over the domains. A document's tokens count for each domain in that proportion. Document
rates r are fitted by projected gradient least squares: they minimise the sum over domains of
(T - target)^2 / m, where T are the expected token totals sum(r * tokens * posterior) and m the
domain's sum(tokens * posterior^2), under r >= least. So weighted, domains that hardly overlap meet
their targets in a few steps. Each step is one aggregation over all documents, from which as many
numbers as there are domains come back. The gradient is taken per token, so that a document's rate
depends on what it is about and not on its length.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sipnote.llm.common import maybe_broadcast, whole
from sipnote.session import written

BUCKETS = 4096
# Labelled documents, about as many at most; a hash of the id decides which.
SAMPLE = 20_000
# Words whose evidence counts in a posterior, however long the text: a softer membership.
EVIDENCE = 20
STEPS, TOLERANCE = 60, 1e-4
# Steps between two written tables; the rates between them are one expression.
STEPS_PER_TABLE = 10


def words_of(text: Column) -> Column:
    """The words between white space, lower-cased."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def constant(values) -> Column:
    """An array (or an array of arrays) of doubles as one constant of the plan.

    Generated code refers to it, so that plans which differ in its numbers alone are compiled once.
    """
    kind = "array<double>" if np.ndim(values) == 1 else "array<array<double>>"
    return F.from_json(F.lit(json.dumps(np.asarray(values, dtype=float).tolist())), kind)


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE) -> tuple[list[str], dict, dict]:
    """Domains that have labelled text, log-weights per bucket of each, and their log-priors.

    ``labelled`` has doc_id and domain. An id with several domains counts for the first in order.
    """
    known = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    texts = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(known), "doc_id")  # about SAMPLE rows
    rows = texts.select("domain", F.explode(words_of(F.col("text"))).alias("word"))
    counts = rows.groupBy("domain", bucket(F.col("word")).alias("bucket")).count().collect()  # domains * BUCKETS
    there = [d for d in domains if any(r["domain"] == d for r in counts)]
    table = {d: np.ones(BUCKETS) for d in there}
    for r in counts:
        table[r["domain"]][r["bucket"]] += r["count"]
    total = sum(t.sum() for t in table.values())
    logs = {d: np.log(t / t.sum()) for d, t in table.items()}
    if logs:
        middle = np.mean(list(logs.values()), axis=0)
        logs = {d: v - middle for d, v in logs.items()}
    return there, logs, {d: float(np.log(t.sum() / total)) for d, t in table.items()}


def members(docs: DataFrame, keep: list[str], domains: list[str], logs: dict, priors: dict) -> DataFrame:
    """(document: the columns ``keep``, tokens, p: posteriors in the order of ``domains``), written."""
    words = F.transform(words_of(whole("text")), bucket)
    names = [f"s{i}" for i in range(len(domains))]
    first = F.struct(F.lit(0).alias("n"), *[F.lit(0.0).alias(s) for s in names])
    weights = [constant(logs[d]) for d in domains]

    def add(sums: Column, b: Column) -> Column:
        more = [(sums[s] + F.get(w, b)).alias(s) for s, w in zip(names, weights)]
        return F.struct((sums["n"] + 1).alias("n"), *more)

    rows = docs.select(F.struct(*keep).alias("document"), F.aggregate(words, first, add).alias("sums"))
    share = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.greatest(F.col("sums.n"), F.lit(1)))
    logits = F.array(*[F.col(f"sums.{s}") * share + F.lit(priors[d]) for s, d in zip(names, domains)])
    raised = F.transform("logits", lambda x: F.exp(x - F.array_max("logits")))
    summed = F.aggregate("raised", F.lit(0.0), lambda a, x: a + x)
    return written(
        rows.select("document", F.col("sums.n").cast("long").alias("tokens"), logits.alias("logits"))
        .select("document", "tokens", raised.alias("raised"))
        .select("document", "tokens", F.transform("raised", lambda x: x / summed).alias("p")),
        "domain-members",
    )


def totals_of(rows: DataFrame, rate: Column, k: int) -> np.ndarray:
    each = [F.coalesce(F.sum(rate * F.col("tokens") * F.col("p")[i]), F.lit(0.0)) for i in range(k)]
    return np.array(rows.agg(*each).first(), dtype=float)


def fit_rates(rows: DataFrame, weights: np.ndarray, total: float | None, least: float) -> tuple[list[np.ndarray], dict]:
    """The directions of the steps taken, from rates of 1, and how close the totals came.

    A document's rate is 1, then after each direction g the larger of ``least`` and rate - g . p.
    Without ``total`` it is the smallest that asks no domain for less than it has.
    """
    k = len(weights)
    now = totals_of(rows, F.lit(1.0), k)
    total = float((now / weights).max()) if total is None else total
    target = weights * total
    report = {"now": now.tolist(), "target": target.tolist(), "reached": now.tolist(), "steps": 0}
    if not now.sum() or not total:
        return [], report
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    moments = rows.agg(*[F.sum(F.col("tokens") * F.col("p")[i] * F.col("p")[j]) for i, j in pairs]).first()
    m = np.zeros((k, k))
    for (i, j), v in zip(pairs, moments):
        m[i, j] = m[j, i] = v
    mass = np.maximum(np.diag(m), 1e-12 * m.max())
    scale = 1 / np.sqrt(mass)
    step = 1 / np.linalg.eigvalsh(scale[:, None] * m * scale).max()
    taken: list[np.ndarray] = []
    base, since = rows.select("tokens", "p").withColumn("rate", F.lit(1.0)), []
    for _ in range(STEPS):
        off = now - target
        if np.abs(off / target).max() < TOLERANCE:
            break
        taken.append(step * off / mass)
        since.append(taken[-1])
        rate = moved(F.col("rate"), since, least)
        if len(since) == STEPS_PER_TABLE:
            base, since = written(base.withColumn("rate", rate), "document-rates"), []
            rate = F.col("rate")
        last, now = now, totals_of(base, rate, k)
        if np.abs((now - last) / target).max() < TOLERANCE / 100:
            break  # the bound keeps it from coming closer
    report |= {"reached": now.tolist(), "steps": len(taken)}
    return taken, report


def moved(rate: Column, directions: list[np.ndarray], least: float) -> Column:
    """The rate after the given steps, one after the other."""
    along = lambda g: F.aggregate(F.zip_with(g, F.col("p"), lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(constant(directions), rate, lambda r, g: F.greatest(F.lit(float(least)), r - along(g)))


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    keep: list[str] | None = None,
    total: float | None = None,
    least: float = 0.0,
    sample: int = SAMPLE,
) -> tuple[DataFrame, dict]:
    """The rate of every document, and a report of totals and steps.

    Returns ``document`` (a struct of the columns ``keep``, doc_id if not given), ``tokens``,
    ``p`` (posteriors of the domains in ``report["domains"]``), ``rate`` and ``copies``: the rate
    rounded up or down by a hash of the id, in expectation the rate itself. Tokens are words between
    white space. ``labelled`` (doc_id, domain) trains the classifier. Target domains without
    labelled text are left out; without any, and for texts without words, rates follow the prior or
    are 1. Rows that repeat get the same rate each; a null id is hashed as such. An empty table
    gives an empty result; other columns are ignored, whatever their names.
    """
    keep = keep or ["doc_id"]
    domains, logs, priors = train(docs, labelled, sorted(targets), sample)
    if not domains:
        none = docs.select(F.struct(*keep).alias("document"), F.size(words_of(whole("text"))).cast("long").alias("tokens"))
        none = none.withColumn("p", F.array().cast("array<double>")).withColumn("rate", F.lit(1.0))
        return none.withColumn("copies", F.lit(1)), {"domains": [], "steps": 0}
    weights = np.array([targets[d] for d in domains], dtype=float)
    weights /= weights.sum()
    rows = members(docs, keep, domains, logs, priors)
    taken, report = fit_rates(rows, weights, total, least)
    rated = rows.withColumn("rate", moved(F.lit(1.0), taken, least) if taken else F.lit(1.0))
    part = F.pmod(F.xxhash64(F.col("document.doc_id"), F.lit(8)), F.lit(1_000_000)) / 1_000_000
    copies = F.floor("rate") + (part < F.col("rate") - F.floor("rate")).cast("int")
    return rated.withColumn("copies", copies.cast("int")), report | {"domains": domains}


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the documents in the table of labels: their language."""
    ids = labels.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(maybe_broadcast(ids, 16), "doc_id", "left_semi")
