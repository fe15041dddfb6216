"""Exact deduplication as a stateful stream.

A streaming aggregation keyed by the digest of the normalised text keeps, in RocksDB state without
expiry: the digest, the number of rows, the stable id of the row that stays and where its content
lies. The state is on disk and in the checkpoint, so it outlives executors and restarts. Digests
that were hit more than once are then checked on their full bytes: their texts are grouped by the
bytes themselves, and a digest that two different texts share is resolved by those groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sipnote.llm.common import lower_ascii, maybe_broadcast, settings, whole
from sipnote.session import new_path, written

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = {
    "spark.sql.streaming.stateStore.providerClass": PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # Many small stores: without it each of them reserves several MB of disk.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def dedup_stream(rows: DataFrame) -> DataFrame:
    """The state as a streaming query: ``rows`` (digest, doc_id, locator) to one row per digest.

    Rows of one digest are counted where they are read, before the shuffle, so a digest that a
    third of all rows share is as cheap as any other. No watermark: nothing expires.
    """
    kept = F.max(F.struct("doc_id", "locator"))
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), kept.alias("kept"))


def run_state(spark: SparkSession, feed: str, schema, checkpoint: str) -> DataFrame:
    """Stream the files of ``feed`` not seen yet into the state, and return the state as a table."""
    with settings(spark, STATE):
        stream = spark.readStream.schema(schema).parquet(feed)
        query = (
            dedup_stream(stream)
            .writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        fields = [f.name for f in state.schema["value"].dataType.fields]
        return written(
            state.select(
                F.col("key.digest").alias("digest"),
                F.col("value").getField(fields[0]).alias("n"),
                F.col("value").getField(fields[1]).alias("kept"),
            ),
            "dedup-state",
        )


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """For every row the row that stays of all rows with an equal text, the largest id of them.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``. Texts are equal if they are after
    lower-casing A-Z; null counts as empty. ``kept`` is true where doc_id is keep_id, for one row of
    a group unless ids repeat (then for each row of that id). A null id loses against any other. An
    empty table gives an empty result; other columns are ignored, whatever their names. ``digest``
    may be weak: equal digests of different texts are told apart.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("doc_id"), lower_ascii(whole(text_col)).alias("text"), F.input_file_name().alias("locator")
    ).withColumn("digest", digest(F.col("text")))
    path = new_path(spark, "dedup-feed")
    columns = ["doc_id", "digest", "locator", F.sha2("text", 256).alias("text_sha256")]
    rows.select(*columns).write.parquet(path)
    feed = spark.read.parquet(path)
    state = run_state(spark, path, feed.schema, new_path(spark, "dedup-checkpoint"))

    hits = state.where("n > 1").select("digest", "n", F.col("kept.doc_id").alias("keep_id"))
    hits = maybe_broadcast(hits, 64)
    # Full bytes: the grouping compares the texts themselves, and moves one text per task and group.
    texts = written(
        rows.join(hits.select("digest"), "digest", "left_semi")
        .groupBy("digest", "text")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("texts")),
        "dedup-bytes",
    )
    shared = texts.where("texts > 1").select("digest")
    clean = feed if shared.isEmpty() else feed.join(maybe_broadcast(shared, 48), "digest", "left_anti")
    result = clean.join(hits, "digest", "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        "text_sha256",
    )
    if not shared.isEmpty():
        same = rows.join(maybe_broadcast(shared, 48), "digest", "left_semi")
        groups = same.groupBy("digest", "text").agg(
            F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id")
        )
        told = same.join(groups, ["digest", "text"]).select(
            "doc_id", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")
        )
        result = result.unionByName(told)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return result.select("doc_id", "keep_id", F.col("group_size").cast("long"), kept.alias("kept"), "text_sha256")


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, one for every text: that with the largest id.

    Rows equal in id and text are copies too, of which any one stays. Other rules as above.
    """
    judged = written(exact_duplicates(docs, id_col, text_col), "dedup-judged")
    key, sha = F.col("_drop.doc_id"), F.sha2(lower_ascii(whole(F.col(f"_docs.{text_col}"))), 256)
    mine = F.col(f"_docs.{id_col}").eqNullSafe(key) & (sha == F.col("_drop.text_sha256"))
    dropped = judged.where("NOT kept").select("doc_id", "text_sha256").distinct()
    kept = docs.alias("_docs").join(maybe_broadcast(dropped, 112).alias("_drop"), mine, "left_anti")
    again = judged.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1").drop("count")
    again = written(again, "dedup-repeated")
    if again.isEmpty():
        return kept
    repeated = maybe_broadcast(again, 112).alias("_drop")
    once = kept.alias("_docs").join(repeated, mine, "left_anti")
    copies = kept.alias("_docs").join(repeated, mine, "left_semi")
    text = lower_ascii(whole(F.col(text_col)))
    one = copies.groupBy(F.col(id_col), text).agg(F.first(F.struct("*")).alias("_row")).select("_row.*")
    return once.unionByName(one)
