"""Error analysis of a scored sample, as one call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from sipnote.operators import evaluation as E
from sipnote.operators.ranking import seeded_sample
from sipnote.session import written


@dataclass
class ErrorAnalysis:
    sample: DataFrame
    report: DataFrame
    matrix: DataFrame
    rate: DataFrame
    errors: DataFrame
    gaps: DataFrame


def analyse_errors(
    scored: DataFrame, true: str, pred: str, key: str = "review_id", text: str = "text", sample_size: int = 1000, seed: int = 42
) -> ErrorAnalysis:
    """Report, confusion matrix, errors and keyword gaps of at most ``sample_size`` rows.

    The sample is a condition on the key, so a scorer that adds ``pred`` only sees its rows; and it
    is written, so that all five results score them once.
    """
    sample = written(seeded_sample(scored, key, sample_size, seed), "error-sample")
    wrong = E.errors(sample, true, pred)
    return ErrorAnalysis(
        sample=sample,
        report=E.classification_report(sample, true, pred),
        matrix=E.confusion_matrix(sample, true, pred),
        rate=E.error_rate(sample, true, pred),
        errors=wrong,
        gaps=E.keyword_gap(wrong, key, text, true, pred),
    )
