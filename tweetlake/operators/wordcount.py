"""Word counts.

Counting is a hash aggregate with map-side partial aggregation, so a word that holds a third
of all rows is combined inside each task before the shuffle and never lands whole on one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tweetlake.functions.text import prepare_line, split_on_space, tokenize_whitespace


def words_split_on_space(lines: DataFrame, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """One row per word of ``String.split(" ")`` (D1), column ``word``."""
    return lines.select(*(keep or []), F.explode(split_on_space(col)).alias("word"))


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Spark word count: split on one space, count per word -> ``(word, count)``."""
    return (words_split_on_space(lines, col)
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def tokens_v2(lines: DataFrame, col: str = "value", case_sensitive: bool = True,
              skip_patterns: list[str] | None = None) -> DataFrame:
    """MapReduce mapper (F5): optional lower-casing, skip-pattern removal, whitespace tokens."""
    line = prepare_line(col, case_sensitive=case_sensitive, skip_patterns=skip_patterns)
    return lines.select(F.explode(tokenize_whitespace(line)).alias("word"))


def word_count_v2(lines: DataFrame, col: str = "value", case_sensitive: bool = True,
                  skip_patterns: list[str] | None = None) -> DataFrame:
    """MapReduce word count (A2): combiner + reducer are Spark's partial + final aggregate."""
    return (tokens_v2(lines, col, case_sensitive, skip_patterns)
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def word_count_v2_observed(lines: DataFrame, col: str = "value", case_sensitive: bool = True,
                           skip_patterns: list[str] | None = None) -> tuple[DataFrame, Observation]:
    """A3: the job counter.  The returned ``Observation`` holds ``input_words`` once an action
    has run on the returned DataFrame, at no extra pass."""
    obs = Observation("wordcount")
    toks = tokens_v2(lines, col, case_sensitive, skip_patterns).observe(obs, F.count(F.lit(1)).alias("input_words"))
    return toks.groupBy("word").agg(F.count(F.lit(1)).alias("count")), obs


def input_words(counts: DataFrame) -> DataFrame:
    """A3 as a table: total number of input words, from the (small) per-word counts."""
    return counts.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("input_words"))
