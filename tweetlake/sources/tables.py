"""Access to the Parquet tables a deployment is given (one folder per scale)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Read ``{base_dir}/{name}.parquet`` as Spark scans it; filters and projections push into
    the scan, and partitions do not depend on the number of cores."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
