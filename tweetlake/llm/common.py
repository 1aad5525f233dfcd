"""What the corpus operators share: words, folds, lineage cuts and shipping to executors."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetlake.session import ensure_checkpoint_dir

#: Fixed value: what separates words (space, tab, line feed, vertical tab, form feed, return).
WORD_GAP = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``{sf_dir}/{name}.parquet`` as Spark scans it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, _UPPER, _UPPER.lower())


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP, -1), lambda w: w != "")


def fold(doc_id: Column, n: int = 4) -> Column:
    """crc32 of the id as text modulo ``n``; null ids fall into fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n), F.lit(0))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may see: fold 2 of 4."""
    return fold(doc_id) == 2


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives lost executors.

    Shuffle files and checkpoints of earlier steps that nothing refers to any more go at the driver's
    next garbage collection, which a large heap may put off for long; it is asked for here.
    """
    ensure_checkpoint_dir(df.sparkSession)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.checkpoint(eager=True)


_REMEMBERED: dict[str, tuple] = {}


def remember(owner: str, *memos: dict) -> None:
    """Let one operator at a time keep its memories in a Python worker: another's are emptied."""
    if owner not in _REMEMBERED:
        for held in _REMEMBERED.values():
            for memo in held:
                memo.clear()
        _REMEMBERED.clear()
        _REMEMBERED[owner] = memos
        _release()


def _release() -> None:
    """Give memory that this process no longer uses back to the system."""
    import ctypes

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application."""
    # Long texts: a batch is bounded by its rows, so that a worker holds few of them at a time.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    sc = spark.sparkContext
    if getattr(sc, "_tweetlake_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tweetlake-ship-"), "tweetlake_ship.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.join(os.path.basename(top), os.path.relpath(full, top)))
    sc.addPyFile(path)
    sc._tweetlake_shipped = True


def sample_rows(df: DataFrame, limit: int, key: Column) -> DataFrame:
    """At most ``limit`` rows in the order of a hash of ``key``: the same rows on every run."""
    return df.withColumn("_order", F.xxhash64(key, F.lit(17))).orderBy("_order", key).limit(limit).drop("_order")
