import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sipnote.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def texts(spark):
    """Make a table (review_id, text) of the given texts."""

    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "review_id long, text string")

    return make


@pytest.fixture
def apply(texts):
    """Apply a column function to texts and return the results in order."""
    from pyspark.sql import functions as F

    def run(function, *values):
        rows = texts(*values).select("review_id", function(F.col("text")).alias("out")).collect()
        return [r.out for r in sorted(rows, key=lambda r: r.review_id)]

    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
