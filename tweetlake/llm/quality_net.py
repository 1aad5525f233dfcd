"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

1. Random indexing over the whole corpus: every token has a fixed sparse ternary index vector
   (from a hash); its context vector is the sum of the index vectors of its neighbours within
   two tokens, and its own, over all documents.  Tokens share 2^14 hash rows, so the table has
   the same size for every corpus; each task sums its part, and tasks' sums are added in two
   rounds, so no task reads the parts of all others.  Sums are whole numbers kept in doubles.
2. A document is the frequency-weighted mean and spread of its tokens' vectors, with its size
   and the diversity of its tokens and triples.
3. A two-layer numpy network learns the label from a bounded sample of labelled rows; a
   temperature fitted on rows it has not seen calibrates the probability.

Defined results: a null or empty text pools to zeros and is scored like any other; without
labelled rows of both classes every score is the share of label 1 (0.5 when there are none);
repeated rows score alike; label rows repeated for an id count once with the larger label; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetlake.llm.common import fold, held_out, remember, sample_rows, ship

ROWS, DIM, CHUNKS, FAN = 1 << 14, 32, 16, 256
WIDTH = 2 * DIM + 4
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_MEMO: dict[bytes, bytes] = {}


def _rows_of(chunk: bytes) -> bytes:
    """The hash rows of a chunk without white space, as unsigned 16-bit numbers."""
    if len(_MEMO) > 250_000:
        _MEMO.clear()
    got = _MEMO[chunk] = np.array([zlib.crc32(w.encode()) % ROWS for w in _TOKEN.findall(chunk.decode())],
                                  dtype=np.uint16).tobytes()
    return got


def token_rows(text: str) -> np.ndarray:
    """The hash rows of a text's tokens in order."""
    remember("rows", _MEMO)
    get = _MEMO.get
    return np.frombuffer(b"".join([get(c) or _rows_of(c) for c in text.encode().split()]), dtype=np.uint16)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Two positions per hash row: one holds +1, the other -1."""
    x = (np.arange(ROWS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    plus = (x % np.uint64(DIM)).astype(np.int64)
    minus = ((x >> np.uint64(20)) % np.uint64(DIM - 1)).astype(np.int64)
    return plus, minus + (minus >= plus)


def context_sums(texts: list[str], total: np.ndarray, counts: np.ndarray) -> None:
    """Add the contexts of the texts' tokens to ``total`` (rows x dim) and their counts."""
    each = [token_rows(t) for t in texts]
    sizes = np.array([len(x) for x in each], dtype=np.int64)
    if not sizes.sum():
        return
    ids = np.concatenate(each).astype(np.int64)
    counts += np.bincount(ids, minlength=ROWS)
    plus, minus = index_vectors()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    flat = total.reshape(-1)
    for gap in (0, 1, 2):
        a, b = ids[:len(ids) - gap], ids[gap:]
        if gap:
            same = doc[:-gap] == doc[gap:]
            a, b = a[same], b[same]
        for to, by in ((a, b), (b, a))[:2 if gap else 1]:
            flat += np.bincount(to * DIM + plus[by], minlength=ROWS * DIM)
            flat -= np.bincount(to * DIM + minus[by], minlength=ROWS * DIM)


def fit_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The ROWS x DIM table of word vectors, weighted by rarity, from every text of ``docs``."""
    ship(docs.sparkSession)
    each = ROWS // CHUNKS

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, counts = np.zeros((ROWS, DIM)), np.zeros(ROWS, dtype=np.int64)
        for part in parts:
            texts = [t or "" for t in part["t"].tolist()]
            for i in range(0, len(texts), 500):
                context_sums(texts[i:i + 500], total, counts)
        if counts.any():
            both = np.hstack([total, counts[:, None]])
            yield pd.DataFrame({"chunk": range(CHUNKS), "sums": [both[k * each:(k + 1) * each].tobytes() for k in range(CHUNKS)]})

    def added(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for part in parts:
            for k, raw in zip(part["chunk"], part["sums"], strict=True):
                x = np.frombuffer(raw, dtype=np.float64)
                held[k] = held[k] + x if k in held else x
        yield pd.DataFrame({"chunk": list(held), "sums": [x.tobytes() for x in held.values()]})

    parts = docs.select(F.col(text_col).alias("t")).mapInPandas(sums, "chunk int, sums binary")
    parts = parts.select("chunk", "sums", F.pmod(F.spark_partition_id(), F.lit(FAN)).alias("some"))
    some = parts.repartition("chunk", "some").select("chunk", "sums").mapInPandas(added, "chunk int, sums binary")
    rows = some.repartition(CHUNKS, "chunk").mapInPandas(added, "chunk int, sums binary").collect()
    both = np.zeros((ROWS, DIM + 1))
    for k, raw in rows:
        both[k * each:(k + 1) * each] = np.frombuffer(raw, dtype=np.float64).reshape(each, DIM + 1)
    counts, context = both[:, DIM], both[:, :DIM]
    seen = counts > 0
    if not seen.any():
        return np.zeros((ROWS, DIM + 1), dtype=np.float32)
    context = context - np.outer(counts, context.sum(0) / counts.sum())
    size = np.linalg.norm(context, axis=1, keepdims=True)
    vectors = np.where(size > 0, context / np.where(size > 0, size, 1), 0)
    weight = 1e-3 / (1e-3 + counts / counts.sum())
    return np.hstack([vectors, weight[:, None]]).astype(np.float32)


def pooled(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """One row per text: weighted mean and spread of the vectors, size, rarity, diversity."""
    v = vectors[:, :DIM] * vectors[:, DIM:]
    table = np.hstack([v, v * v, vectors[:, DIM:]])
    x = np.zeros((len(texts), WIDTH), dtype=np.float32)
    for i, t in enumerate(texts):
        ids = token_rows(t)
        n = len(ids)
        if not n:
            continue
        s = np.sort(ids)
        ends = np.append(np.flatnonzero(s[1:] != s[:-1]), n - 1)
        sums = np.diff(ends, prepend=-1).astype(np.float32) @ table[s[ends]]
        weight = max(float(sums[2 * DIM]), 1e-9)
        mean = sums[:DIM] / weight
        x[i, :DIM] = mean
        x[i, DIM:2 * DIM] = np.sqrt(np.maximum(sums[DIM:2 * DIM] / weight - mean * mean, 0))
        x[i, 2 * DIM:2 * DIM + 3] = np.log1p(n), weight / n, len(ends) / n
        if n > 2:
            w = ids.astype(np.int64)
            w = np.sort((w[:-2] * ROWS + w[1:-1]) * ROWS + w[2:])
            x[i, 2 * DIM + 3] = (1 + np.count_nonzero(w[1:] != w[:-1])) / len(w)
        else:
            x[i, 2 * DIM + 3] = 1
    return x


class QualityNet:
    """Standardised features, one hidden layer, one logit, one temperature."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature=1.0):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2
        self.temperature = temperature

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


class ConstantNet:
    def __init__(self, value: float):
        self.value = value

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def train(x: np.ndarray, y: np.ndarray, calibration: np.ndarray, hidden: int = 24, epochs: int = 60):
    """Adam on mini-batches of the rows outside ``calibration``; those fit the temperature."""
    if len(set(y.tolist())) < 2:
        return ConstantNet(float(y.mean()) if len(y) else 0.5)
    if len(set(y[~calibration].tolist())) < 2 or not calibration.any():
        calibration = np.zeros(len(y), bool)
    xt, yt = x[~calibration].astype(np.float64), y[~calibration].astype(np.float64)
    mean, scale = xt.mean(0), xt.std(0) + 1e-6
    z = np.clip((xt - mean) / scale, -8, 8)
    rng = np.random.default_rng(7)
    d = z.shape[1]
    p = [rng.normal(0, 1 / np.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    step = 0
    for _ in range(epochs * max(1, min(8, 4000 // len(z)))):
        order = rng.permutation(len(z))
        for i in range(0, len(z), 256):
            xb, yb = z[order[i:i + 256]], yt[order[i:i + 256]]
            h = np.tanh(xb @ p[0] + p[1])
            e = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - yb) / len(yb)
            back = np.outer(e, p[2]) * (1 - h * h)
            g = [xb.T @ back + 1e-4 * p[0], back.sum(0), h.T @ e + 1e-4 * p[2], np.array([e.sum()])]
            step += 1
            for k in range(4):
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - 0.004 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    net = QualityNet(mean, scale, p[0], p[1], p[2], p[3])
    rows = calibration if calibration.any() else np.ones(len(y), bool)
    logit, truth = net.logit(x[rows].astype(np.float64)), y[rows]
    def loss(t):
        return np.logaddexp(0, np.where(truth == 1, -logit, logit) / t).mean()
    net.temperature = float(min(np.geomspace(0.5, 8, 49), key=loss))
    return net


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 8000,
        corpus: DataFrame | None = None):
    """Word vectors from all of ``corpus`` (default: ``docs``), a network from a bounded sample
    of at most ``max_rows`` labelled rows that are not held out."""
    vectors = fit_vectors(docs if corpus is None else corpus)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    ids = sample_rows(ids, max_rows, F.col("doc_id"))

    def features(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            x = pooled([t or "" for t in part["t"].tolist()], shared.value)
            yield pd.DataFrame({"doc_id": part["doc_id"], "y": part["y"], "f": part["f"], "x": [r.tobytes() for r in x]})

    # At most max_rows ids: small by its parameter.
    rows = (docs.select("doc_id", F.col("text").alias("t")).join(F.broadcast(ids), "doc_id")
            .withColumn("f", fold(F.col("doc_id"))).select("doc_id", "t", "y", "f")
            .mapInPandas(features, "doc_id long, y int, f long, x binary").toPandas())
    rows = rows.sort_values(["doc_id", "x"])
    x = np.array([np.frombuffer(r, dtype=np.float32) for r in rows["x"]]).reshape(len(rows), WIDTH)
    net = train(x, rows["y"].to_numpy(dtype=np.int64), (rows["f"] == 1).to_numpy(dtype=bool))
    return vectors, net


def scorer(spark, model):
    """A column function: text -> probability of label 1."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vectors, net = shared.value
        for s in parts:
            yield pd.Series(net.probability(pooled([t or "" for t in s.tolist()], vectors)))

    return probability


def score(docs: DataFrame, model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    df = docs.select("doc_id", scorer(docs.sparkSession, model)(F.col(text_col)).alias("score"))
    return df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                     (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier accepts."""
    p = scorer(docs.sparkSession, model)
    df = docs.select(F.struct("*").alias("_doc"), p(F.col("text")).alias("_p"))
    return df.where(F.col("_p") >= threshold).select("_doc.*")


