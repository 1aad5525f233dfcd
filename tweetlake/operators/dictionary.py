"""Dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dictionary_from_tokens(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """Distinct tokens of an array column -> ``(token)``."""
    return df.select(F.explode(tokens_col).alias("token")).distinct()


def dictionary_from_words(words: DataFrame, col: str = "word") -> DataFrame:
    """Distinct words -> ``(token)``."""
    return words.select(F.col(col).alias("token")).distinct()


def dictionary_from_counts(counts: DataFrame, col: str = "word") -> DataFrame:
    """A8 + P9: keys of a per-word count table (same rows as A6)."""
    return counts.select(F.col(col).alias("token"))
