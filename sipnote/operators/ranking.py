"""First rows, seeded samples and exact stratified splits without sorting the table.

All of them ask for "the q first rows by some order". A sort or a window would bring a whole
stratum (a label holds a third of the rows or more) to one task. Instead a mergeable quantile sketch
of every stratum, made in one narrow pass over key and label, brackets the place of the q-th row. A
second narrow pass counts the rows before the bracket and ranks only those inside; where a sketch
leaves too many of them, the bracket is sketched again. The row found there is a threshold. For one
order over all rows it is a constant of a row-wise condition, pushed down to the scan where the
order is a plain column. Thresholds of many strata are a table with one row each, joined by label.

A bracket is checked by the counts and widened if a sketch was off by more than it states, so the
result is exact. Rows with a null key come last. Rows of one key are told apart by a hash of all
their columns, computed in a pass of its own for rows at a threshold alone, and only where the
threshold divides them; rows equal in every column stay together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sipnote.operators.lookup import fits_broadcast
from sipnote.session import written

BUCKETS = 65_536
# Items a sketch keeps; ranks it gives are off by a quarter of SLACK at most, nearly always.
SKETCH = 2048
SLACK = 0.01
# Strata up to this size are in their sketch whole.
EXACT_ROWS = 1000
SHARES = 400
# A bracket with more rows than this is sketched again before its rows are ranked.
RANKED_ROWS = 100_000
MOST_ROUNDS = 12


def seeded_hash(seed: int, key: str) -> Column:
    """A reproducible pseudo-random order of the rows; null for a null key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def _tie(df: DataFrame) -> Column:
    """A hash of the whole row."""
    hashable = [f"`{f.name}`" for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.xxhash64(*hashable)


def _hash_number(hashed: Column) -> Column:
    """The first 52 bits of a hash in hex, in the same order."""
    return F.conv(F.left(hashed, F.lit(13)), 16, 10).cast("long")


@dataclass
class Order:
    """An order of rows by ``items``; ``place`` is a number that goes with it, null for a null key."""

    place: Column
    whole_numbers: bool
    items: dict[str, Column]

    def place_or_last(self) -> Column:
        if self.whole_numbers:
            return F.coalesce(self.place.cast("long"), F.lit(2**63 - 1))
        return F.coalesce(F.nanvl(self.place.cast("double"), F.lit(float("inf"))), F.lit(float("inf")))

    def item(self) -> Column:
        """What decides the order; null keys after all others, and alike."""
        known = self.place.isNotNull()
        return F.struct((~known).alias("unknown"), *[F.when(known, c).alias(name) for name, c in self.items.items()])

    def sketch(self, place: Column) -> Column:
        kind = F.kll_sketch_agg_bigint if self.whole_numbers else F.kll_sketch_agg_double
        return kind(place, F.lit(SKETCH))


def _hashed_order(seed: int, key: str) -> Order:
    hashed = seeded_hash(seed, key)
    return Order(_hash_number(hashed), True, {"hash": hashed, "key": F.col(key)})


def _number_order(df: DataFrame, key: str) -> Order:
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    return Order(F.col(key), whole, {"key": F.col(key)})


def _tie_order() -> Order:
    return Order(F.col("tie"), True, {"tie": F.col("tie")})


def _sketches(rows: DataFrame, order: Order) -> DataFrame:
    """(label, n, sketch, below) of the places of each stratum; no row lies below yet."""
    own = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), order.sketch(F.col("place")).alias("sketch"))
    return own.withColumn("below", F.lit(0).cast("long"))


def _of_strata(rows: DataFrame, label: str, table: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per stratum; ``few``: it fits a broadcast."""
    own = table.withColumnRenamed("label", "_of")
    return rows.join(F.broadcast(own) if few else own, F.col(label).eqNullSafe(F.col("_of")), how).drop("_of")


def _with_quotas(stats: DataFrame, quotas: DataFrame, few: bool) -> DataFrame:
    """``stats`` of the strata whose ``quota`` is above zero, with it; written."""
    return written(_of_strata(stats, "label", quotas.select("label", "quota").where("quota > 0"), few), "sketches")


def _brackets(stats: DataFrame, order: Order, slack: float) -> DataFrame:
    """(label, low, high, quota, within): around the place of the row asked for, and how many rows that may hold."""
    quantile = F.kll_sketch_get_quantile_bigint if order.whole_numbers else F.kll_sketch_get_quantile_double
    share, exact = (F.col("quota") - F.col("below")) / F.col("n"), F.col("n") <= EXACT_ROWS
    near = F.when(exact, 1.5 / F.col("n")).otherwise(F.lit(slack))
    # Quantiles are asked for at fixed shares; those next to the bracket's ends, outwards, are its ends.
    places = quantile("sketch", F.array(*[F.lit(i / SHARES) for i in range(SHARES + 1)]))
    low = F.greatest(F.lit(0), F.floor((share - near) * SHARES)).cast("int")
    high = F.least(F.lit(SHARES), F.ceil((share + near) * SHARES)).cast("int")
    within = F.when(exact, F.lit(0.0)).otherwise(F.col("n") * (high - low) / SHARES)
    found = stats.select("label", "quota", places.alias("places"), low.alias("from"), high.alias("to"), within.alias("within"))
    return found.select("label", F.get("places", "from").alias("low"), F.get("places", "to").alias("high"), "quota", "within")


def _thresholds(rows: DataFrame, order: Order, stats: DataFrame, few: bool) -> tuple[DataFrame, bool]:
    """Per stratum the ``item`` of the ``quota``-th row, the ``n`` rows that have it, and how many of them are in
    (``left``); and whether any is divided.

    ``rows`` has label, place and item, ``stats`` label, n, sketch, below and quota, 1 <= quota <= n.
    """
    for slack in (SLACK, 8 * SLACK, 1.0):
        found = _within_brackets(rows, order, stats, slack, few)
        if found is not None:
            return found
    raise RuntimeError("the rows changed between passes")


def _within_brackets(
    rows: DataFrame, order: Order, stats: DataFrame, slack: float, few: bool
) -> tuple[DataFrame, bool] | None:
    """As :func:`_thresholds`; none if a bracket turns out not to hold its row."""
    inside = F.col("place").between(F.col("low"), F.col("high"))
    for _ in range(MOST_ROUNDS):
        brackets = _brackets(stats, order, slack)
        near = _of_strata(rows, "label", brackets.select("label", "low", "high", "quota"), few)
        strata, wide = brackets.agg(F.count(F.lit(1)), F.count_if((F.col("within") > RANKED_ROWS) & (F.col("low") < F.col("high")))).first()
        if slack >= 1 or not wide:
            break
        again = near.groupBy("label").agg(
            F.count_if(inside).alias("n"),
            order.sketch(F.when(inside, F.col("place"))).alias("sketch"),
            F.count_if(F.col("place") < F.col("low")).alias("below"),
            F.first("quota").alias("quota"),
        )
        stats = written(again, "sketches")
        if not stats.where(~(F.col("quota") - F.col("below")).between(1, F.col("n"))).isEmpty():
            return None
    # Rows before the bracket are counted as one; their item is null, which comes first.
    counted = near.where(F.col("place") <= F.col("high")).groupBy("label", F.when(F.col("place") >= F.col("low"), F.col("item")).alias("item"))
    counted = counted.agg(F.count(F.lit(1)).alias("n"), F.first("quota").alias("quota"))
    upto = F.sum("n").over(Window.partitionBy("label").orderBy("item"))
    left = F.col("quota") - upto + F.col("n")
    found = counted.withColumn("left", left).where(F.col("left").between(1, F.col("n")))
    found = written(found.select("label", "item", "n", "left"), "thresholds")
    rows_found, known, divided = found.agg(F.count(F.lit(1)), F.count("item"), F.count_if(F.col("left") < F.col("n"))).first()
    return (found, divided > 0) if rows_found == known == strata else None


def _last_rows(df: DataFrame, label: Column, order: Order, rows: DataFrame, stats: DataFrame, few: bool) -> tuple[DataFrame, bool]:
    """(label, item, tie) of the last row to take of every stratum, no tie where all rows of its item are in;
    and whether there is any tie."""
    found, divided = _thresholds(rows, order, stats, few)
    if not divided:
        return found.select("label", "item", F.lit(None).cast("long").alias("tie")), False
    open_ = found.where("left < n")
    marked = df.select(label.alias("label"), order.item().alias("own"), _tie(df).alias("tie"))
    same = _of_strata(marked, "label", open_.select("label", "item"), few).where(F.col("own") == F.col("item"))
    by_tie = _tie_order()
    same = same.select("label", by_tie.place_or_last().alias("place"), by_tie.item().alias("item"))
    quotas = open_.select("label", F.col("left").alias("quota"))
    ties, _ = _thresholds(same, by_tie, _with_quotas(_sketches(same, by_tie), quotas, few), few)
    last = _of_strata(found, "label", ties.select("label", F.col("item.tie").alias("tie")), few, "left")
    return written(last.select("label", "item", "tie"), "last-rows"), True


def _up_to(columns: list[Column], last: tuple) -> Column:
    """True up to and including ``last`` in the order of the columns, compared one by one."""
    head, value = columns[0], F.lit(last[0])
    if len(columns) == 1:
        return head <= value
    return (head < value) | ((head == value) & _up_to(columns[1:], last[1:]))


def _first(df: DataFrame, n: int, order: Order) -> Column:
    """Condition for the ``n`` first rows by ``order``, rows with a null key after all others."""
    if n <= 0:
        return F.lit(False)
    one = F.lit(0)
    rows = df.select(one.alias("label"), order.place_or_last().alias("place"), order.item().alias("item"))
    stats = written(_sketches(rows, order), "sketches")
    facts = stats.select("n").first()
    if facts is None or n >= facts["n"]:
        return F.lit(True)
    last = _last_rows(df, one, order, rows, stats.withColumn("quota", F.lit(n).cast("long")), True)[0].first()
    known, tie, t = order.place.isNotNull(), _tie(df), last["tie"]
    if last["item"]["unknown"]:
        return F.lit(True) if t is None else known | (tie <= F.lit(t))
    values = tuple(last["item"][name] for name in order.items)
    columns = list(order.items.values())
    return known & (_up_to(columns, values) if t is None else _up_to([*columns, tie], (*values, t)))


def in_first_n(df: DataFrame, key: str, n: int) -> Column:
    """Condition on the rows of ``df`` that holds for those of :func:`first_n`."""
    return _first(df, n, _number_order(df, key))


def in_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> Column:
    """Condition on the rows of ``df`` that holds for those of :func:`seeded_sample`."""
    return _first(df, n, _hashed_order(seed, key))


def first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The rows with the ``n`` smallest values of a numeric key, null keys last."""
    return df.where(in_first_n(df, key, n))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` rows, the same ones for the same seed whatever the partitioning."""
    return df.where(in_sample(df, key, n, seed))


def split_quotas(counts: DataFrame, numerator: int = 1, denominator: int = 5) -> DataFrame:
    """(label, n, quota): test rows per label, adding up to the share of all rows, rounded up.

    ``counts`` has label and n. Whole-number arithmetic; rows left over by rounding down go to the
    largest remainders, ties in the order of the labels, a null label last.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    wanted = -(-total * numerator // denominator)
    product = F.lit(wanted).cast("decimal(38,0)") * F.col("n").cast("decimal(20,0)")
    shares = counts.withColumn("_base", F.floor(product / F.lit(max(total, 1)).cast("decimal(20,0)")).cast("long"))
    shares = shares.withColumn("_rest", (product - F.col("_base") * F.lit(total).cast("decimal(20,0)")).cast("long"))
    left = wanted - (shares.agg(F.coalesce(F.sum("_base"), F.lit(0))).first()[0])
    # The rows left over are fewer than there are labels.
    more = shares.orderBy(F.desc("_rest"), F.asc_nulls_last("label")).limit(left).select(F.col("label").alias("_more"), F.lit(1).alias("_one"))
    joined = shares.join(more, F.col("label").eqNullSafe(F.col("_more")), "left")
    return joined.select("label", "n", (F.col("_base") + F.coalesce("_one", F.lit(0))).alias("quota"))


def label_table(table: DataFrame) -> DataFrame:
    """Mark a table with one row per label for a broadcast if its measured size allows."""
    return F.broadcast(table) if fits_broadcast(table) else table


def stratified_split(
    df: DataFrame, key: str, label: str, seed: int = 42, numerator: int = 1, denominator: int = 5
) -> DataFrame:
    """Add ``split`` (train or test) with exact sizes and the label shares of the whole table.

    Any number of labels, null among them. Two narrow passes over key and label find one threshold
    per label; the table itself is not shuffled while the thresholds fit a broadcast.
    """
    order = _hashed_order(seed, key)
    rows = df.select(F.col(label).alias("label"), order.place_or_last().alias("place"), order.item().alias("item"))
    stats = written(_sketches(rows, order), "sketches")
    # The tables joined below have a row for each stratum, and some hundred bytes beside its label.
    few = fits_broadcast(stats.select("label", *[F.lit(0).alias(f"_{i}") for i in range(8)]))
    quotas = split_quotas(stats.select("label", "n"), numerator, denominator)
    last, tied = _last_rows(df, F.col(label), order, rows, _with_quotas(stats, quotas, few), few)
    # One comparison of structs; with ties, of rows at a threshold by their hash too.
    own = order.item()
    in_test = own <= F.col("_item")
    if tied:
        in_test &= (own < F.col("_item")) | F.col("_tie").isNull() | (_tie(df) <= F.col("_tie"))
    joined = _of_strata(df, label, last.select("label", F.col("item").alias("_item"), F.col("tie").alias("_tie")), few, "left")
    chosen = F.when(F.col("_item").isNotNull() & in_test, "test").otherwise("train")
    return joined.select(*[F.col(c) for c in df.columns if c != "split"], chosen.alias("split"))


def stratified_folds(df: DataFrame, key: str, label: str, folds: int = 3, seed: int = 42) -> DataFrame:
    """Add ``fold`` (0 to folds-1) by the exact rank of a row within its label, a null label too.

    The rank is the number of rows in earlier buckets plus the rank within the bucket, so a
    label is ranked by many tasks at once. Rows of one key, and those with a null key, come in the order
    of a hash of the row; the latter have as many buckets of their own. Join and window share one partitioning.
    """
    hashed, tie = seeded_hash(seed, key), _tie(df)
    leading = F.conv(F.left(hashed, F.lit(4)), 16, 10).cast("int")
    unknown = F.lit(BUCKETS) + F.shiftrightunsigned(tie.bitwiseXOR(F.lit(-(2**63))), 48).cast("int")
    # A null label is a stratum of its own; as a struct it is a value like any other.
    keyed = df.withColumn("_tie", tie).withColumn("_hash", hashed).withColumn("_bucket", F.coalesce(leading, unknown))
    keyed = keyed.withColumn("_label", F.struct(label))
    running = Window.partitionBy("_label").orderBy("_bucket")
    offsets = (
        keyed.groupBy("_label", "_bucket")
        .count()
        .withColumn("_before", F.sum("count").over(running) - F.col("count"))
        .select("_label", "_bucket", "_before")
    )
    in_bucket = Window.partitionBy("_label", "_bucket").orderBy("_hash", key, "_tie")
    rank = F.col("_before") + F.row_number().over(in_bucket) - 1
    return (
        keyed.join(offsets, ["_label", "_bucket"])
        .withColumn("fold", (rank % folds).cast("int"))
        .select(*df.columns, "fold")
    )
