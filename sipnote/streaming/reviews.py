"""The stateless part of the library on a stream of review files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sipnote import schema
from sipnote.functions.cleaning import CleanOptions
from sipnote.plans.process import process_reviews


def read_review_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema.REVIEW).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def process_review_stream(
    spark: SparkSession, folder: str, target: str, checkpoint: str, options: CleanOptions = CleanOptions()
) -> StreamingQuery:
    """Clean and count every review that is there now, and remember what was done.

    No state is kept between rows, so nothing grows with the length of the stream.
    """
    processed = process_reviews(read_review_stream(spark, folder), options)
    return (
        processed.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
