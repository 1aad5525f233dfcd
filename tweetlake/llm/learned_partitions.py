"""Approximate nearest neighbours by learned partitions of a neighbour graph.

Fitting, on a bounded sample of distinct vectors (``SAMPLE_ROWS`` rows, ``SAMPLE_VALUES``
components):

1. Spark tasks find every sample vector's nearest neighbours; the graph is cut into parts of
   nearly equal size, by medians along principal axes and then by moving vectors to the part
   most of their neighbours are in, as long as the sizes allow.
2. A two-layer network learns the parts of a vector's neighbours from the vector.
3. Part of the sample is left out as queries: a query visits parts from the most probable on,
   until the probability passed reaches a mass that would have found the share ``recall`` of
   those queries' true neighbours.

Indexing covers every row: equal vectors become one with their smallest ids (as many as an answer
can hold), and each goes to its most probable part.  Searching sends a query to its parts;
parts are cut into cells of bounded rows and queries, and every cell ranks by the distance on the
original vectors.

Defined results: vectors that are null, zero, of another length than most rows have, or that hold
null or non-finite components take no part, nor does a null vec_id; repeated rows count
once; an id with unlike vectors is a row, and a query, for each, and a query never meets rows of
its own id; with too few vectors to cut there is one part and the search is exact; an empty table
gives an empty result; other columns do not enter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tweetlake.llm.common import cut, remember, ship

SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 4_000_000
NEIGHBOURS, HIDDEN, EPOCHS, MOST_PARTS = 10, 128, 24, 256
CELL_ROWS, CELL_QUERIES = 16_384, 4_096
_LOADED: dict[str, object] = {}


def clean(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec) of the rows that take part, components as doubles."""
    vec = F.transform("embedding", lambda x: x.cast("double"))
    usable = (F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    rows = (vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
            .select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where(usable))
    usual = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("vec") == (usual["size"] if usual else 0))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """(vec, ids): every vector once, with its ``ids`` smallest ids."""
    nth = F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))
    return (rows.withColumn("_nth", nth).where(F.col("_nth") <= ids)
            .groupBy("vec").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")))


def nearest(points: np.ndarray, queries: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Rows of ``points`` nearest to each query, at most ``k`` and not the query's ``own``."""
    far = (points ** 2).sum(1)[None, :] - 2 * queries @ points.T
    if own is not None:
        far[np.arange(len(queries)), own] = np.inf
    return np.argpartition(far, min(k, far.shape[1]) - 1, axis=1)[:, :k]


def halve(points: np.ndarray, parts: int) -> np.ndarray:
    """Parts of sizes that differ by one at most: medians along the main axis, again and again."""
    part = np.zeros(len(points), np.int64)
    for _ in range(parts.bit_length() - 1):
        fresh = np.empty_like(part)
        for p in range(part.max() + 1):
            rows = np.flatnonzero(part == p)
            x = points[rows] - points[rows].mean(0)
            axis = np.ones(x.shape[1])
            for _ in range(12):
                axis = x.T @ (x @ axis) + 1e-12
                axis /= np.linalg.norm(axis)
            order = rows[np.argsort(x @ axis, kind="stable")]
            fresh[order[: len(order) // 2]] = 2 * p
            fresh[order[len(order) // 2:]] = 2 * p + 1
        part = fresh
    return part


def settle(part: np.ndarray, neighbours: np.ndarray, parts: int, rounds: int = 12, slack: float = 0.1) -> np.ndarray:
    """Move vectors to the part most of their neighbours are in while every part stays within
    ``slack`` of the mean size; the greatest gains go first."""
    n = len(part)
    a = np.repeat(np.arange(n), neighbours.shape[1])
    b = neighbours.ravel()
    most, least = int(np.ceil(n / parts * (1 + slack))), int(n / parts * (1 - slack))
    part = part.copy()
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (a, part[b]), 1)
        np.add.at(votes, (b, part[a]), 1)
        to = votes.argmax(1)
        gain = votes[np.arange(n), to] - votes[np.arange(n), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[to[i]] < most and size[part[i]] > least:
                size[to[i]] += 1
                size[part[i]] -= 1
                part[i] = to[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """A two-layer network from a vector to the probabilities of the parts."""

    def __init__(self, size: int, parts: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.parts, self.mass = parts, 1.0
        self.w = [rng.normal(0, (2 / size) ** 0.5, (size, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts)]
        self.centre, self.scale = np.zeros(size), 1.0

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(x @ self.w[0] + self.w[1], 0)
        z = h @ self.w[2] + self.w[3]
        e = np.exp(z - z.max(1, keepdims=True))
        return h, e / e.sum(1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward((x - self.centre) / self.scale)[1]

    def fit(self, x: np.ndarray, target: np.ndarray, epochs: int = EPOCHS, batch: int = 256, rate: float = 2e-3, seed: int = 7) -> None:
        """Cross-entropy against the ``target`` shares, by Adam."""
        self.centre, self.scale = x.mean(0), max(float(x.std()), 1e-12)
        x = (x - self.centre) / self.scale
        rng, step = np.random.default_rng(seed), 0
        m, v = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows, step = order[at:at + batch], step + 1
                h, p = self._forward(x[rows])
                dz = (p - target[rows]) / len(rows)
                dh = (dz @ self.w[2].T) * (h > 0)
                grads = [x[rows].T @ dh, dh.sum(0), h.T @ dz, dz.sum(0)]
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)

    def passed(self, x: np.ndarray) -> np.ndarray:
        """Of every part, the probability of the parts visited before it."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, 1), 1) - np.take_along_axis(p, order, 1)
        out = np.empty_like(p)
        np.put_along_axis(out, order, before, 1)
        return out

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.probabilities(x).argmax(1)


def parts_for(n: int) -> int:
    """A power of two near half the root of the number of vectors; one part below 64 vectors."""
    return 1 if n < 64 else min(MOST_PARTS, 1 << max(2, (int(n ** 0.5) // 2).bit_length() - 1))


def _graph(spark, points: np.ndarray) -> np.ndarray:
    """Nearest neighbours among the sample, found by tasks over blocks of its rows."""
    held, block = spark.sparkContext.broadcast(points), 512

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = held.value
        for frame in frames:
            for b in frame["id"]:
                rows = np.arange(b * block, min(len(x), (b + 1) * block))
                yield pd.DataFrame({"row": rows, "near": list(nearest(x, x[rows], NEIGHBOURS, rows))})

    blocks = -(-len(points) // block)
    got = spark.range(0, blocks, 1, blocks).mapInPandas(found, "row long, near array<long>").toPandas()
    held.unpersist()
    return np.stack(got.sort_values("row")["near"].tolist())


def fit(distinct: DataFrame, recall: float = 0.97, sample_rows: int = SAMPLE_ROWS) -> Router | None:
    """The router of ``distinct`` (vec, ids); None if there are too few vectors to cut."""
    spark = distinct.sparkSession
    ship(spark)
    about = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("size")).first()
    parts = parts_for(about.n)
    if parts == 1:
        return None
    limit = max(64, min(sample_rows, SAMPLE_VALUES // about["size"]))
    order = F.xxhash64("vec", F.lit(17))
    some = (distinct.select("vec", order.alias("o")).where(F.pmod(F.xxhash64("vec", F.lit(23)), F.lit(about.n)) < int(1.2 * limit))
            .orderBy("o").limit(limit).collect())
    points = np.array([r.vec for r in some])
    queries, points = points[: len(points) // 10], points[len(points) // 10:]
    near = _graph(spark, points)
    part = settle(halve(points, parts), near, parts)
    target = np.zeros((len(points), parts))
    np.add.at(target, (np.arange(len(points)), part), 1)
    np.add.at(target, (np.repeat(np.arange(len(points)), near.shape[1]), part[near].ravel()), 1)
    router = Router(points.shape[1], parts)
    router.fit(points, target / target.sum(1, keepdims=True))
    # The mass that finds the share `recall` of the left-out queries' neighbours, where indexing puts them.
    truth = np.concatenate([nearest(points, q, NEIGHBOURS) for q in np.array_split(queries, 1 + len(queries) // 256) if len(q)])
    passed = router.passed(queries)
    needed = np.sort(np.take_along_axis(passed, router.home(points)[truth], 1).ravel())
    router.mass = float(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])
    return router


def _routed(df: DataFrame, router: Router | None, column: str, all_parts: bool) -> DataFrame:
    """``df`` with ``part``: the most probable one, or a row for each part that a query visits."""
    if router is None:
        return df.withColumn("part", F.lit(0))
    held, name = df.sparkSession.sparkContext.broadcast(router), uuid.uuid4().hex
    schema = df.select("*", F.lit(0).alias("part")).schema

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember("learned_partitions", _LOADED)
        r = _LOADED.setdefault(name, held.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(column).flatten().to_numpy().reshape(batch.num_rows, -1)
            if all_parts:
                row, part = np.nonzero(r.passed(x) <= r.mass)
                batch = batch.take(pa.array(row))
            else:
                part = r.home(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], schema=pa.schema([*batch.schema, pa.field("part", pa.int32())]))

    return df.mapInArrow(go, schema)


def index(distinct: DataFrame, router: Router | None) -> DataFrame:
    """(vec, ids, part): every distinct vector in its most probable part."""
    return _routed(distinct, router, "vec", False)


def _rank_cell(best: int):
    def rank(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            x, ids = np.stack(rows["vec"].tolist()), rows["ids"].tolist()
            square = (x ** 2).sum(1)
            for at in range(0, len(queries), 256):
                some = queries.iloc[at:at + 256]
                q = np.stack(some["sought"].tolist())
                own = (q ** 2).sum(1)
                far = own[:, None] + square[None, :] - 2 * q @ x.T
                k = min(best + 1, far.shape[1])
                bar = np.partition(far, k - 1, axis=1)[:, k - 1]
                # What rounding of the expanded squares can hide, many times over.
                bar = bar + 1e-12 * (own + square.max())
                for i, (query, tag) in enumerate(zip(some["query_id"], some["tag"])):
                    at_rows = np.flatnonzero(far[i] <= bar[i])
                    exact = np.sqrt(((x[at_rows] - q[i]) ** 2).sum(1))
                    found = sorted((d, v) for d, r in zip(exact.tolist(), at_rows.tolist()) for v in ids[r] if v != query)[:best]
                    out += [(query, tag, v, d) for d, v in found]
        return pd.DataFrame(out, columns=["query_id", "tag", "vec_id", "score"])
    return rank


def search(indexed: DataFrame, queries: DataFrame, router: Router | None, best: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest found, nearest first, ties to smaller ids."""
    tag = F.xxhash64("vec")
    asked = queries.select(F.col("vec_id").alias("query_id"), tag.alias("tag"), F.col("vec").alias("sought")).dropDuplicates(["query_id", "tag"])
    asked = cut(_routed(asked, router, "sought", True))
    # One row per part: how many blocks its rows and its queries make.
    size = (indexed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("row_blocks"))
            .join(asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("query_blocks")), "part"))
    size = F.broadcast(size)
    last = F.sequence(F.lit(0), F.col("query_blocks") - 1)
    rows = (indexed.join(size, "part").withColumn("row_block", F.pmod(F.xxhash64("vec", F.lit(5)), "row_blocks").cast("int"))
            .select("part", "row_block", F.explode(last).alias("query_block"), "vec", "ids"))
    last = F.sequence(F.lit(0), F.col("row_blocks") - 1)
    asked = (asked.join(size, "part").withColumn("query_block", F.pmod(F.xxhash64("query_id", "tag"), "query_blocks").cast("int"))
             .select("part", F.explode(last).alias("row_block"), "query_block", "query_id", "tag", "sought"))
    cell = ["part", "row_block", "query_block"]
    found = asked.groupBy(*cell).cogroup(rows.groupBy(*cell)).applyInPandas(
        _rank_cell(best), "query_id long, tag long, vec_id long, score double")
    order = Window.partitionBy("query_id", "tag").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
            .select("query_id", "rank", "vec_id", "score"))


def neighbours(vectors: DataFrame, every: int = 100, best: int = 10, recall: float = 0.97) -> DataFrame:
    """The nearest of all rows for every row whose vec_id is divisible by ``every``."""
    ship(vectors.sparkSession)
    rows = clean(vectors)
    distinct = cut(distinct_vectors(rows, best + 1))
    router = fit(distinct, recall)
    indexed = cut(index(distinct, router))
    return search(indexed, rows.where(F.col("vec_id") % every == 0), router, best)
