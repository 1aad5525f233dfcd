"""Evaluation (M16-M18, P8, P19, A4, A5) as aggregates over ``(prediction, label)`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetlake.functions.numeric import squared_error


def mismatches(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """P8."""
    return df.where(F.col(prediction) != F.col(label))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Share of rows predicted right, with the row count (A4)."""
    return df.agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def test_error(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Mismatches / rows."""
    wrong = (F.col(prediction) != F.col(label)).cast("long")
    return df.agg(F.sum(wrong).alias("n_wrong"), F.count(F.lit(1)).alias("n"),
                  (F.sum(wrong) / F.count(F.lit(1))).alias("test_error"))


def mse(df: DataFrame, prediction: str = "prediction", label: str = "label",
        denominator_rows: int | None = None) -> DataFrame:
    """M18 + P19 + A5: sum of squared errors and its mean.  ``denominator_rows`` divides by a
    different row count (the reference divides the test sum by all rows, D12)."""
    se = squared_error(prediction, label)
    n = F.count(F.lit(1)) if denominator_rows is None else F.lit(denominator_rows)
    return df.agg(F.sum(se).alias("sse"), F.count(F.lit(1)).alias("n"), (F.sum(se) / n).alias("mse"))
