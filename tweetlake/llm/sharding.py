"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

A table as read already lies in partitions: its files, in runs of ``block_rows`` neighbouring rows,
the blocks.  How many rows each block sends to each shard is drawn exactly, without replacement from the
shards' capacities.  The matrix is never held whole: all blocks are the leaves of a binary
tree, each node splits its places of every shard between its halves by exact hypergeometric draws,
and a task follows the tree down to the blocks it reads (the law of the whole matrix is the same).
Each block is permuted where it is read, the rows are exchanged **once**, and every shard is
permuted again.  Shard sizes differ by at most one row, and every assignment of rows to places is
as likely as any other up to the quality of the random numbers.

Row, block and draw follow from a row's place in its file alone, so a lost task is redone alike however
the scan was cut into tasks, and equal rows are spread like any others.  A shard's second
permutation is by ranges of a random key, counted first, so no task holds a whole shard.  Python gets the
places only, never the rows.

Defined results: a null text has no bytes; repeated rows take places of their own; an empty
table gives an empty result; all columns are kept, ``shard`` and ``slot`` of the input are
replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tweetlake.llm.common import ship
from tweetlake.session import scratch_path

_HELD = 4096


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    if good == 0:
        return 0
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    # Beyond numpy's range: the probabilities around the mode, from the ratios of neighbours.
    mode = (n + 1) * (good + 1) // (good + bad + 2)
    wide = 14 * (math.isqrt(n * good // (good + bad) * bad // (good + bad)) + 2)
    k = np.arange(max(0, n - bad, mode - wide), min(n, good, mode + wide) + 1, dtype=np.float64)
    logs = np.concatenate([[0.0], np.cumsum(np.log(good - k[:-1]) + np.log(n - k[:-1]) - np.log(k[:-1] + 1)
                                            - np.log(bad - n + k[:-1] + 1))])
    total = np.cumsum(np.exp(logs - logs.max()))
    return int(k[min(len(k) - 1, np.searchsorted(total, rng.random() * total[-1], side="right"))])


class Matrix:
    """The communication matrix, drawn a row at a time; ``before(b)`` rows lie before block ``b``."""

    def __init__(self, before: Callable[[int], int], n_blocks: int, n_shards: int, seed: int = 0):
        self.before, self.n_blocks, self.n_shards, self.seed = before, n_blocks, n_shards, seed % 2**63
        self.height = max(0, n_blocks - 1).bit_length()
        self._nodes: dict[tuple[int, int], list[int]] = {}
        self._last: tuple[int, np.ndarray, np.ndarray] | None = None

    def _node(self, depth: int, index: int) -> list[int]:
        """The places of every shard that the blocks below a node of the tree fill."""
        if depth == 0:
            total = self.before(self.n_blocks)
            return [total // self.n_shards + (k < total % self.n_shards) for k in range(self.n_shards)]
        got = self._nodes.get((depth, index))
        if got is not None:
            return got
        above = self._node(depth - 1, index // 2)
        wide, first = 1 << (self.height - depth), index & ~1
        edge = [self.before(min(self.n_blocks, (first + k) * wide)) for k in (0, 1)]
        rng = np.random.default_rng([self.seed, 0, depth, first])
        beyond, want, left = sum(above), edge[1] - edge[0], []
        for places in above:
            beyond -= places
            take = 0 if not want else want if not beyond else _hypergeometric(rng, places, beyond, want)
            left.append(take)
            want -= take
        if len(self._nodes) > _HELD:
            self._nodes.clear()
        self._nodes[depth, first] = left
        self._nodes[depth, first + 1] = [a - b for a, b in zip(above, left, strict=True)]
        return self._nodes[depth, index]

    def row(self, block: int) -> list[int]:
        """How many rows ``block`` sends to each shard."""
        return self._node(self.height, block)

    def places(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """The shard of each row of a block, permuted, and the random keys of the second permutation."""
        if self._last is None or self._last[0] != block:
            rng = np.random.default_rng([self.seed, 1, block])
            shards = rng.permutation(np.repeat(np.arange(self.n_shards, dtype=np.int32), self.row(block)))
            self._last = block, shards, rng.integers(0, 2**63, len(shards), dtype=np.int64)
        return self._last[1:]


def communication_matrix(rows: list[int], n_shards: int, seed: int = 0) -> np.ndarray:
    """blocks x shards counts: rows of the blocks, columns of sizes at most one apart."""
    before = np.concatenate([[0], np.cumsum(rows)]).tolist()
    m = Matrix(before.__getitem__, len(rows), n_shards, seed)
    return np.array([m.row(b) for b in range(len(rows))], dtype=np.int64).reshape(len(rows), n_shards)


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """(_row, _at) with ``_at`` from 0 in the order of files and rows, and the number of rows."""
    placed = rows.select("_row", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    # One row per file, which the driver lists for the scan anyway.
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("n"), F.min("_index").alias("lo"), F.max("_index").alias("hi"))
    starts, total = [], 0
    for f in sorted(files.collect()):
        if f["lo"] != 0 or f["hi"] != f["n"] - 1:
            raise ValueError("a stored table must be all rows of its files, each once")
        starts.append((f["_file"], total))
        total += f["n"]
    at = rows.sparkSession.createDataFrame(starts, "_file string, _start long")
    return placed.join(F.broadcast(at), "_file").select("_row", (F.col("_start") + F.col("_index")).alias("_at")), total


def shard(df: DataFrame, n_shards: int = 40, seed: int = 0, block_rows: int = 20_000, stored: bool = False) -> DataFrame:
    """``df`` with ``shard`` (0 to n_shards - 1) and ``slot`` (0, 1, ... within the shard).

    ``stored`` says that ``df`` is a Parquet table as read, with all rows (columns may be left out); any
    other is first written to the shared folder, since its rows need places that stay.
    """
    spark = df.sparkSession
    ship(spark)
    names = [c for c in df.columns if c not in ("shard", "slot")]
    if stored:
        rows = df.select(F.struct(*names).alias("_row"), "_metadata")
    else:
        held = df.select(F.struct(*names).alias("_row"))
        path = scratch_path(spark, "shard")
        held.write.parquet(path)
        rows = spark.read.schema(held.schema).parquet(path)
    numbered, total = _numbered(rows)
    n_blocks = -(-total // block_rows)

    @F.pandas_udf("shard int, key long")
    def drawn(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matrix = Matrix(lambda b: min(total, b * block_rows), n_blocks, n_shards, seed)
        for batch in batches:
            at = batch.to_numpy(dtype=np.int64)
            block, inside = at // block_rows, at % block_rows
            shards, keys = np.empty(len(at), np.int32), np.empty(len(at), np.int64)
            for b in np.unique(block):
                mine = block == b
                s, k = matrix.places(int(b))
                shards[mine], keys[mine] = s[inside[mine]], k[inside[mine]]
            yield pd.DataFrame({"shard": shards, "key": keys})

    parts = max(1, -(-total // (n_shards * block_rows)))
    sent = (numbered.withColumn("_to", drawn("_at"))
            .select("_row", "_at", F.col("_to.shard").alias("_shard"), F.col("_to.key").alias("_key"))
            .withColumn("_part", F.pmod(F.shiftright("_key", 20), F.lit(parts))))
    again = F.row_number().over(Window.partitionBy("_shard", "_part").orderBy("_key", "_at")) - 1
    out = sent.withColumn("_slot", again)
    if parts > 1:
        sizes = sent.groupBy("_shard", "_part").agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy("_shard").orderBy("_part")
        base = sizes.select("_shard", "_part", (F.sum("n").over(before) - F.col("n")).alias("_base"))
        out = out.join(base, ["_shard", "_part"]).withColumn("_slot", F.col("_slot") + F.col("_base"))
    return out.select("_row.*", F.col("_shard").cast("int").alias("shard"), F.col("_slot").cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, n_shards: int = 40, seed: int = 0) -> DataFrame:
    """The shards as Parquet folders ``shard=k`` in slot order; returns what was written."""
    out = shard(df, n_shards, seed)
    out.repartition(n_shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.parquet(path)
