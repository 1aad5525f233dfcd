"""Views, SQL text and schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name the DataFrame for SQL."""
    df.createOrReplaceTempView(name)
    return df


def names_in_range(spark: SparkSession, view: str, name_col: str, value_col: str,
                   low: int = 13, high: int = 19) -> DataFrame:
    """``SELECT name FROM view WHERE value >= low AND value <= high``, planned by Catalyst
    (the range predicate reaches the Parquet scan as pushed filters)."""
    return spark.sql(
        f"SELECT {name_col} AS name FROM {view} WHERE {value_col} >= :low AND {value_col} <= :high",
        args={"low": low, "high": high})


_SCHEMA_TABLE = StructType([
    StructField("position", IntegerType(), False),
    StructField("field_name", StringType(), False),
    StructField("data_type", StringType(), False),
    StructField("nullable", BooleanType(), False),
])


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as rows ``(position, field_name, data_type, nullable)`` -- one row per
    top-level field (metadata only; nothing of the data passes through the driver)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, _SCHEMA_TABLE)
