"""Embedding near-dedup by collision counting on sorted one-dimensional projections.

1. Bit-equal vectors form a class; only classes are compared.
2. Every vector has M random projections.  For a pair at the threshold cosine the difference
   of a projection is normal with a known spread; each projection is sorted, and a window of
   2.5 spreads to either side of the query's value holds the partner with a known probability.
3. A pair is verified if it collides in at least L of the M windows; L is the largest count
   that all but one in 100,000 pairs at the threshold reach (closer pairs collide more).
4. Verification is the cosine in double precision over the whole vectors.

Classes are dealt into blocks by a hash, and two blocks meet in one task, so that all pairs
are compared; the number of block pairs grows with the square of the rows (one-dimensional
windows hold a constant share of all pairs).  A task returns link counts per class and a
spanning forest of its links, never the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and
rows without vec_id, link with nothing and are kept (component: the vec_id itself); vectors of
different lengths never link; repeated rows with one vec_id are vectors that link; an empty
table gives an empty result; other columns do not enter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tweetlake.llm.common import cut, ship
from tweetlake.llm.components import components

M, SPREADS, BLOCK_ROWS, TILE = 32, 2.5, 4096, 1024


def least_collisions(m: int = M, spreads: float = SPREADS, miss: float = 1e-5) -> int:
    """The largest count that all but ``miss`` of the pairs at the threshold reach."""
    p = math.erf(spreads / math.sqrt(2))
    below = 0.0
    for k in range(m + 1):
        below += math.comb(m, k) * p**k * (1 - p) ** (m - k)
        if below > miss:
            return k
    return m


def _directions(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, M))


def linked_pairs(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (into x, into y) of the pairs of unit rows with at least the cosine."""
    at = _directions(x.shape[1])
    px, py = x @ at, y @ at
    half = SPREADS * math.sqrt(2 - 2 * cosine)
    hits = np.zeros((len(x), len(y)), dtype=np.uint8)
    for j in range(M):
        order = np.argsort(py[:, j], kind="stable")
        rank = np.empty(len(y), dtype=np.uint16)
        rank[order] = np.arange(len(y), dtype=np.uint16)
        values = py[order, j]
        low = np.searchsorted(values, px[:, j] - half, side="left").astype(np.uint16)
        wide = np.searchsorted(values, px[:, j] + half, side="right").astype(np.uint16) - low
        # low <= rank < low + wide, in unsigned numbers.
        hits += (rank[None, :] - low[:, None]) < wide[:, None]
    a, b = np.nonzero(hits >= least_collisions())
    if len(a) > hits.size // 50:
        good = (x @ y.T)[a, b] >= cosine
    else:
        good = np.zeros(len(a), bool)
        for i in range(0, len(a), 50_000):
            good[i:i + 50_000] = np.einsum("ij,ij->i", x[a[i:i + 50_000]], y[b[i:i + 50_000]]) >= cosine
    return a[good], b[good]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of n nodes."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row; see the module's text."""
    ship(vectors.sparkSession)
    element = vectors.schema["embedding"].dataType.elementType
    kind = np.float32 if isinstance(element, T.FloatType) else np.float64

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column("vec_id"), []
            for known, v in zip(ids.is_valid().to_pylist(), batch.column("embedding"), strict=True):
                v = v.values if known else None
                x = None if v is None or v.null_count else v.to_numpy(zero_copy_only=False).astype(np.float64)
                fine = x is not None and len(x) and np.isfinite(x).all() and x.any()
                out.append(x.astype(kind).tobytes() if fine else None)
            # Ids stay in Arrow: a null beside them would turn large ones into other numbers in pandas.
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary())], ["vec_id", "v"])

    base = cut(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(raw, "vec_id long, v binary"))
    # Ids are given after the cut: the rows and their order are fixed from there on.
    classes = cut(base.where("v IS NOT NULL").groupBy("v").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))).withColumn("cid", F.monotonically_increasing_id())
    blocks = max(1, -(-classes.count() // block_rows))
    at = F.pmod(F.xxhash64("cid"), F.lit(blocks)).cast("int")
    dealt = (classes.withColumn("block", at).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select("cid", "n", "v", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))

    def compared(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        i, j = key
        out = []
        rows = rows.sort_values("cid")
        for size in sorted({len(v) for v in rows["v"]}):
            same = rows[[len(v) == size for v in rows["v"]]]
            x = np.frombuffer(b"".join(same["v"]), dtype=kind).reshape(len(same), -1).astype(np.float64)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            cid, n, block = same["cid"].to_numpy(), same["n"].to_numpy(), same["block"].to_numpy()
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            links = np.zeros(len(x), dtype=np.int64)
            pairs = []
            for p in range(0, len(left), TILE):
                for q in range(p if i == j else 0, len(right), TILE):
                    ls, rs = left[p:p + TILE], right[q:q + TILE]
                    a, b = linked_pairs(x[ls], x[rs], cosine)
                    a, b = ls[a], rs[b]
                    if i == j and p == q:
                        a, b = a[a < b], b[a < b]
                    np.add.at(links, a, n[b])
                    np.add.at(links, b, n[a])
                    # A forest of what is linked so far, so that pairs don't pile up.
                    pairs.append((a, b))
                    if sum(len(u) for u, _ in pairs) > 500_000:
                        f = _forest(len(x), *[np.concatenate(z) for z in zip(*pairs, strict=True)])
                        pairs = [(np.arange(len(x)), f)]
            f = _forest(len(x), *[np.concatenate(z) for z in zip(*pairs, strict=True)]) if pairs else np.arange(len(x))
            has = np.flatnonzero((links > 0) | (f != np.arange(len(x))))
            out.append(pd.DataFrame({"cid": cid[has], "links": links[has], "root": cid[f[has]]}))
        return pd.concat(out) if out else pd.DataFrame({"cid": [], "links": [], "root": []})

    found = cut(dealt.groupBy("i", "j").applyInPandas(compared, "cid long, links long, root long"))
    label = components(found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = (classes.join(sums, "cid", "left").join(label.withColumnRenamed("node", "cid"), "cid", "left")
             .select("v", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("label", "cid").alias("label")))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    named = named.join(least, "label").select("v", "n_links", "component_id")
    out = base.where("v IS NOT NULL").join(named, "v").select("vec_id", "n_links", "component_id")
    alone = base.where("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
