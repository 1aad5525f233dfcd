"""Text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.ml.functions import array_to_vector

from tweetlake.functions.text import longer_than, parse_numbers, split_lines


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``; a directory is read whole."""
    return spark.read.text(path)


def lines_of(df: DataFrame, text_col: str, keep: list[str] | None = None,
             position_col: str | None = None) -> DataFrame:
    """Turn a multi-line text column into one row per line (column ``line``), as if each
    text were a file read with S1.  ``keep`` columns ride along; ``position_col`` adds the
    0-based line number."""
    keep = keep or []
    if position_col:
        return df.select(*keep, F.posexplode(split_lines(text_col)).alias(position_col, "line"))
    return df.select(*keep, F.explode(split_lines(text_col)).alias("line"))


def read_numeric_vectors(spark: SparkSession, path: str, trim: bool = True,
                         min_length: int | None = None) -> DataFrame:
    """Numeric text, one vector per line split on one space -> ``features`` vector.
    ``min_length`` applies P5 first (the LDA readers keep lines longer than 2 characters)."""
    df = read_text(spark, path)
    if min_length is not None:
        df = df.where(longer_than("value", min_length))
    return df.select(array_to_vector(parse_numbers("value", trim=trim)).alias("features"))


def read_skip_patterns(spark: SparkSession, path: str) -> list[str]:
    """A side file with one regex per line, in file order.  The file is a parameter
    list (a handful of lines), so it is brought to the driver and folded into the plan."""
    rows = (spark.read.text(path)
            .select(F.monotonically_increasing_id().alias("pos"), "value")
            .orderBy("pos").collect())
    return [r.value for r in rows]
