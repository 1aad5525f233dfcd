"""libsvm source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``(label double, features vector)``.  Giving ``num_features`` avoids the extra
    pass that otherwise finds the largest index."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)
