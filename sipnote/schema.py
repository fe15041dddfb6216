"""Table schemas. Readers never infer types."""

from pyspark.sql import types as T

REVIEW = T.StructType(
    [
        T.StructField("review_id", T.LongType()),
        T.StructField("beer_name", T.StringType()),
        T.StructField("style", T.StringType()),
        T.StructField("rating_overall", T.DoubleType()),
        T.StructField("text", T.StringType()),
    ]
)

# The wider export: same reviews with ids, reviewer, time as read, and the part ratings.
WIDE_REVIEW = T.StructType(
    REVIEW.fields
    + [
        T.StructField("beer_id", T.LongType()),
        T.StructField("brewer_id", T.LongType()),
        T.StructField("review_profileName", T.StringType()),
        T.StructField("review_time", T.StringType()),
        T.StructField("rating_taste", T.DoubleType()),
        T.StructField("rating_appearance", T.DoubleType()),
        T.StructField("rating_palate", T.DoubleType()),
        T.StructField("rating_aroma", T.DoubleType()),
    ]
)
