"""Positional indexing.

``zipWithIndex`` semantics -- a dense 0-based number in a total order -- without funnelling all
rows through one task: range-sort by an explicit key, materialise the sorted rows once into
the shared checkpoint folder (so both passes below see identical partitions), count rows per
partition (one tiny row per partition), turn counts into offsets and add each row's position
inside its partition.  The offsets table has one row per partition, a bound known in advance,
so broadcasting it is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tweetlake.session import cut_lineage, scratch_path


def number_rows(df: DataFrame, index_col: str = "index", columnar: bool = False) -> DataFrame:
    """``df`` with ``index_col`` (bigint), a dense number from 0 in the order its partitions are read.  The rows
    are written once into the checkpoint folder, so whoever reads the result gets the same numbers
    and does not compute ``df`` again; if ``columnar``, as Parquet: words that repeat are kept once a file, and
    who needs few columns reads only these."""
    tagged = df.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    tagged = _columnar(tagged) if columnar else cut_lineage(tagged)
    per_part = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(*df.columns, (F.col("_off") + local).cast("bigint").alias(index_col)))


def _columnar(df: DataFrame) -> DataFrame:
    """``df`` written and read again; the numbers are columns, so it does not matter how files are read."""
    path = scratch_path(df.sparkSession, "rows")
    df.write.option("parquet.dictionary.page.size", str(1 << 24)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_index(df: DataFrame, order_by: list, index_col: str = "index") -> DataFrame:
    """Add ``index_col`` (bigint) = 0-based position of the row in ``order_by`` order.
    Ties in ``order_by`` are numbered in an arbitrary but fixed order; give a unique key."""
    return number_rows(df.orderBy(*order_by), index_col)


def index_tokens(dictionary: DataFrame, token_col: str = "token", index_col: str = "term_id") -> DataFrame:
    """Token -> its 0-based line number in the sorted dictionary (binary string order)."""
    return with_index(dictionary.select(token_col), [F.col(token_col)], index_col)


def index_rows(df: DataFrame, key_col: str, index_col: str = "doc_index") -> DataFrame:
    """W1 + P10: ``(index, key)`` pairs, index first as after ``swap``."""
    idx = with_index(df.select(key_col), [F.col(key_col)], index_col)
    return idx.select(index_col, key_col)


def number_lines(spark: SparkSession, path: str, index_col: str = "line_no") -> DataFrame:
    """W1 without a key: ``(line_no, value)``, every text line of a file or folder with its 0-based number, files in
    the order of their paths, lines in the order of their file.

    The scan knows each line's file and split, and a split is read by one task in order.  So lines are
    only counted by split (one row per split, which is what is broadcast) and never sorted or moved.
    """
    lines = spark.read.text(path).select(
        "value", F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("_split"),
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid"))
    lines = cut_lineage(lines)
    splits = lines.groupBy("_split", "_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_low"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_split", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_off"))
    return (lines.select("value", "_split", "_mid").join(F.broadcast(offsets), "_split")
            .select((F.col("_off") + F.col("_mid")).cast("bigint").alias(index_col), "value"))
