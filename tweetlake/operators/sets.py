"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows present in both inputs, once each (nulls match).  Repeats go in a partial
    aggregate before the shuffle."""
    return a.distinct().intersect(b.distinct())


def bag_union(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept, columns matched by name."""
    return reduce(lambda x, y: x.unionByName(y), dfs)


def distinct_rows(df: DataFrame) -> DataFrame:
    """A6."""
    return df.distinct()
