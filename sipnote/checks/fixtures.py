"""The check views as DataFrames over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sipnote.checks import fixture_sql
from sipnote.sources.tables import read_parquet, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents"))
    # The join key doc_id % 200 only meets keys 0 to 199 of the unique part key: at most 200 rows.
    part = F.broadcast(table(spark, sf_dir, "part").where("p_partkey BETWEEN 0 AND 199"))
    return spark.sql(fixture_sql.REVIEWS, documents=documents, part=part)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        fixture_sql.PREDICTIONS, reviews=reviews(spark, sf_dir), labels=table(spark, sf_dir, "labels")
    )


def translation_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(fixture_sql.TRANSLATION_MEMORY, reviews=reviews(spark, sf_dir))
