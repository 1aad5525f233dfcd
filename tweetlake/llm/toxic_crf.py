"""Toxicity with a two-state linear-chain conditional random field.

1. Document labels are projected on tokens: in a bounded sample of labelled documents, words
   and word beginnings that occur in toxic documents oftener than chance allows (binomial tail
   below 0.05 over the number of features) mark tokens of those documents as toxic; further
   rounds do the same for the toxic documents left without a mark.
2. A CRF (word, word-beginning and word-ending features; transitions between clean and toxic)
   is fitted to those tokens by gradient ascent on the exact likelihood.
3. Every whole text is tagged: forward-backward marginals per token give the offending
   offsets, and their maximum, sum and share give a calibrated document score.

Forward-backward runs over all documents of a batch at once, as one chain whose transition
into a document's first token forgets what came before; the chain is cut into blocks that
numpy advances side by side.

Defined results: a null or empty text has no tokens and gets the score of a document without
toxic evidence; without labelled rows of both classes every score is the share of toxic
labels (0 when there are none); repeated rows score alike; label rows repeated for an id count
once with the larger label; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetlake.llm.common import fold, held_out, sample_rows, ship

_WORD = re.compile(r"[^\W\d_]+")
SPAN_AT = 0.5


def features_of(word: str) -> tuple[str, ...]:
    """The word, its first 4 and 5 letters and its last 4."""
    return (f"w={word}", f"a={word[:4]}", f"b={word[:5]}", f"z={word[-4:]}")


def marginals(s: np.ndarray, first: np.ndarray, trans: np.ndarray, start: float,
              pairs: bool = False):
    """P(toxic) of each token, and the expected transition counts if asked for.

    s: emission log-odds of toxic; first: whether a token begins a document; trans: 2 x 2
    transition log-weights (row: from); start: log-odds of a document's first state.
    """
    n = len(s)
    if n == 0:
        return np.zeros(0), np.zeros((2, 2))
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    pad = rows * width - n
    e = np.exp(np.clip(np.concatenate([s, np.zeros(pad)]), -30, 30))
    f = np.concatenate([first.astype(bool), np.zeros(pad, bool)])
    f[0] = True
    t = np.exp(trans)
    # m[a][b]: weight of going from a to b and emitting the token.
    m = [[np.where(f, w, t[a, b]) * (e if b else 1.0) for b, w in ((0, 1.0), (1, np.exp(start)))] for a in (0, 1)]
    m = [[np.ascontiguousarray(x.reshape(rows, width).T) for x in r] for r in m]
    p = [[np.ones(rows), np.zeros(rows)], [np.zeros(rows), np.ones(rows)]]
    for k in range(width):
        q = [[p[a][0] * m[0][b][k] + p[a][1] * m[1][b][k] for b in (0, 1)] for a in (0, 1)]
        z = 1 / (q[0][0] + q[0][1] + q[1][0] + q[1][1])
        p = [[x * z for x in r] for r in q]
    into, outof = np.empty((rows, 2)), np.empty((rows, 2))
    flat = np.stack([p[0][0], p[0][1], p[1][0], p[1][1]], 1).tolist()
    a0, a1 = 0.5, 0.5
    for r, (x, y, u, v) in enumerate(flat):
        into[r] = a0, a1
        a0, a1 = a0 * x + a1 * u, a0 * y + a1 * v
        a0, a1 = a0 / (a0 + a1), a1 / (a0 + a1)
    b0, b1 = 1.0, 1.0
    for r in range(rows - 1, -1, -1):
        outof[r] = b0, b1
        x, y, u, v = flat[r]
        b0, b1 = x * b0 + y * b1, u * b0 + v * b1
        b0, b1 = b0 / (b0 + b1), b1 / (b0 + b1)
    al = np.empty((2, width, rows))
    x, y = into[:, 0], into[:, 1]
    for k in range(width):
        x, y = x * m[0][0][k] + y * m[1][0][k], x * m[0][1][k] + y * m[1][1][k]
        z = 1 / (x + y)
        x, y = x * z, y * z
        al[0, k], al[1, k] = x, y
    out = np.empty((width, rows))
    joint = np.zeros((2, 2))
    x, y = outof[:, 0], outof[:, 1]
    fresh = f.reshape(rows, width).T
    for k in range(width - 1, -1, -1):
        up = al[1, k] * y
        out[k] = up / (al[0, k] * x + up)
        if pairs:
            pa = (al[0, k - 1], al[1, k - 1]) if k else (into[:, 0], into[:, 1])
            j = [[pa[a] * m[a][b][k] * (y if b else x) for b in (0, 1)] for a in (0, 1)]
            z = np.where(fresh[k], 0.0, 1 / (j[0][0] + j[0][1] + j[1][0] + j[1][1]))
            joint += [[(j[a][b] * z).sum() for b in (0, 1)] for a in (0, 1)]
        x, y = m[0][0][k] * x + m[0][1][k] * y, m[1][0][k] * x + m[1][1][k] * y
        z = 1 / (x + y)
        x, y = x * z, y * z
    return out.T.reshape(-1)[:n], joint


def _summary(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per document: greatest marginal, log of one plus their sum, their share of the tokens."""
    out = np.zeros((len(sizes), 3))
    has = sizes > 0
    if has.any():
        at = np.concatenate([[0], np.cumsum(sizes[has])[:-1]])
        total = np.add.reduceat(p, at)
        out[has] = np.stack([np.maximum.reduceat(p, at), np.log1p(total), total / sizes[has]], 1)
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([0.05] * x.shape[1] + [1e-4])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge
        w = w + np.linalg.solve(h, z.T @ (y - p) - ridge @ w)
    return w[:-1], float(w[-1])


def _tail(k: int, n: int, share: float) -> float:
    """P(at least k of n) for a binomial."""
    lg = math.lgamma
    top = [lg(n + 1) - lg(i + 1) - lg(n - i + 1) + i * math.log(share) + (n - i) * math.log1p(-share)
           for i in range(k, n + 1)]
    return math.exp(min(0.0, max(top))) * sum(math.exp(x - max(top)) for x in top)


class ToxicCrf:
    """The fitted model: feature weights, transitions, calibration."""

    def __init__(self, weights: dict[str, float], trans: np.ndarray, start: float,
                 beta: np.ndarray, bias: float):
        self.weights, self.trans, self.start, self.beta, self.bias = weights, trans, start, beta, bias
        self._memo: dict[bytes, bytes] = {}

    def __getstate__(self):
        return self.__dict__ | {"_memo": {}}

    def _emissions(self, chunk: bytes) -> bytes:
        """The emission scores of a chunk without white space, as 32-bit floats."""
        if len(self._memo) > 500_000:
            self._memo.clear()
        get, bias = self.weights.get, self.weights["bias"]
        got = self._memo[chunk] = np.array([sum(get(f, 0.0) for f in features_of(w.lower())) + bias
                                            for w in _WORD.findall(chunk.decode())], dtype=np.float32).tobytes()
        return got

    def tag(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens' marginals, text after text, and the texts' token counts."""
        get, miss = self._memo.get, self._emissions
        each = [b"".join([get(c) or miss(c) for c in t.encode().split()]) for t in texts]
        sizes = np.array([len(x) // 4 for x in each], dtype=np.int64)
        s = np.frombuffer(b"".join(each), dtype=np.float32).astype(np.float64)
        first = np.zeros(len(s), bool)
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        return marginals(s, first, self.trans, self.start)[0], sizes

    def score(self, texts: list[str]) -> pd.DataFrame:
        p, sizes = self.tag(texts)
        x = _summary(p, sizes)
        z = 1 / (1 + np.exp(-np.clip(x @ self.beta + self.bias, -30, 30)))
        at = np.cumsum(sizes) - sizes
        starts, ends = [[] for _ in texts], [[] for _ in texts]
        for i in np.flatnonzero(x[:, 0] >= SPAN_AT):
            bad = p[at[i]:at[i] + sizes[i]] >= SPAN_AT
            hits = [m.span() for m, b in zip(_WORD.finditer(texts[i]), bad, strict=True) if b]
            starts[i], ends[i] = [a for a, _ in hits], [b for _, b in hits]
        return pd.DataFrame({"score": z, "span_starts": starts, "span_ends": ends})


class ConstantModel:
    """Scores every text alike: what can be said without labels of both classes."""

    def __init__(self, value: float):
        self.value = value

    def score(self, texts: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"score": [self.value] * len(texts), "span_starts": [[] for _ in texts],
                             "span_ends": [[] for _ in texts]})


def train(texts: list[str], labels: np.ndarray, calibration: np.ndarray, steps: int = 40):
    """Fit on the sample; rows marked ``calibration`` only fit the document score."""
    if len(set(labels.tolist())) < 2:
        return ConstantModel(float(labels.mean()) if len(labels) else 0.0)
    if not (set(labels[calibration].tolist()) == {0, 1} == set(labels[~calibration].tolist())):
        calibration = np.zeros(len(labels), bool)
    fit = [i for i in range(len(texts)) if not calibration[i]]
    docs = [[w.lower() for w in _WORD.findall(texts[i])] for i in fit]
    y_doc = labels[fit]
    bags = [{f for w in set(ws) for f in features_of(w)} for ws in docs]
    marks: set[str] = set()
    left = [i for i in range(len(bags)) if y_doc[i]]
    good = [i for i in range(len(bags)) if not y_doc[i]]
    clean = Counter(f for i in good for f in bags[i])
    df = clean + Counter(f for i in left for f in bags[i])
    # Toxic documents that hold a mark are explained; the next round looks at the others only.
    while left:
        bad = Counter(f for i in left for f in bags[i])
        share = len(left) / (len(left) + len(good))
        level = 0.05 / max(1, len(df))
        new = {f for f, c in bad.items() if not f.startswith("z=") and c > 3 * share * (c + clean[f])
               and _tail(c, c + clean[f], share) < level} - marks
        if not new:
            break
        marks |= new
        left = [i for i in left if not bags[i] & marks]
    vocab = {f: i for i, f in enumerate(sorted(f for f, c in df.items() if c >= 3))}
    words: dict[str, int] = {}
    of_word, of_feature, marked = [], [], []
    ids, states, sizes = [], [], []
    for ws, y in zip(docs, y_doc, strict=True):
        for w in ws:
            k = words.get(w)
            if k is None:
                k = words[w] = len(words)
                fs = features_of(w)
                marked.append(any(f in marks for f in fs))
                known = [vocab[f] for f in fs if f in vocab]
                of_word += [k] * len(known)
                of_feature += known
            ids.append(k)
            states.append(bool(y) and marked[k])
        sizes.append(len(ws))
    ids, states, sizes = np.array(ids), np.array(states, bool), np.array(sizes)
    of_word, of_feature = np.array(of_word, dtype=np.int64), np.array(of_feature, dtype=np.int64)
    first = np.zeros(len(ids), bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    theta = np.zeros(len(vocab) + 1 + 5)  # features, bias, transitions, start
    nv = len(vocab)
    theta[nv] = -3.0
    inside = np.zeros((2, 2))
    after = ~first[1:]
    for a in (0, 1):
        for b in (0, 1):
            inside[a, b] = np.sum((states[:-1] == a) & (states[1:] == b) & after)
    by_word = np.bincount(ids, weights=states, minlength=len(words))
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        s_word = np.bincount(of_word, weights=theta[of_feature], minlength=len(words)) + theta[nv]
        p, joint = marginals(s_word[ids], first, theta[nv + 1:nv + 5].reshape(2, 2), theta[nv + 5], pairs=True)
        gap = by_word - np.bincount(ids, weights=p, minlength=len(words))
        g = np.zeros_like(theta)
        g[:nv] = np.bincount(of_feature, weights=gap[of_word], minlength=nv)
        g[nv] = gap.sum()
        g[nv + 1:nv + 5] = (inside - joint).ravel()
        g[nv + 5] = (states[first].sum() - p[first].sum())
        g -= 0.02 * theta
        m1 = 0.9 * m1 + 0.1 * g
        m2 = 0.99 * m2 + 0.01 * g * g
        theta = theta + 0.4 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    weights = {f: round(float(theta[i]), 4) for f, i in vocab.items() if abs(theta[i]) >= 0.01}
    weights["bias"] = float(theta[nv])
    model = ToxicCrf(weights, theta[nv + 1:nv + 5].reshape(2, 2).copy(), float(theta[nv + 5]), np.zeros(3), 0.0)
    rows = np.flatnonzero(calibration) if calibration.any() else np.arange(len(texts))
    x = _summary(*model.tag([texts[i] for i in rows]))
    model.beta, model.bias = _logistic(x, labels[rows].astype(float))
    return model


def admitted(sizes: np.ndarray, labels: np.ndarray, max_chars: int) -> np.ndarray:
    """Which rows, in sampling order, enter a sample of ``max_chars`` characters.

    Texts of at most a hundredth of the room come first, in order; what room all of them leave goes to the
    longer ones, shortest first.  If a class would be missing, each class has half of the room to itself.
    """
    def filled(at: np.ndarray, room: int) -> np.ndarray:
        short = at[sizes[at] <= room // 100]
        took = short[np.cumsum(sizes[short]) <= room]
        if len(took) == len(short):
            long = at[sizes[at] > room // 100]
            long = long[np.argsort(sizes[long], kind="stable")]
            took = np.concatenate([took, long[np.cumsum(sizes[long]) <= room - sizes[took].sum()]])
        return took

    took = filled(np.arange(len(sizes)), max_chars)
    if set(labels[took].tolist()) != set(labels.tolist()):
        took = np.concatenate([filled(np.flatnonzero(labels == y), max_chars // 2) for y in (0, 1)])
    keep = np.zeros(len(sizes), bool)
    keep[took] = True
    return keep


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_chars: int) -> DataFrame:
    """At most ``max_rows`` labelled rows of distinct texts, not held out, of ``max_chars`` in all."""
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("_label")))
    ids = sample_rows(ids, max_rows, F.col("doc_id"))
    # At most max_rows ids: small by its parameter.
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
            .join(F.broadcast(ids), "doc_id").withColumn("_hash", F.xxhash64("_text")))
    first = rows.groupBy("_hash").agg(F.min_by(F.struct("doc_id", "_label", F.length("_text").alias("_size")), "doc_id").alias("_r"))
    found = first.select("_hash", "_r.*").orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id", "_hash").toPandas()
    keep = admitted(found["_size"].to_numpy(dtype=np.int64), found["_label"].to_numpy(dtype=np.int64), max_chars)
    chosen = docs.sparkSession.createDataFrame(
        [(int(i), int(h)) for i, h in zip(found["doc_id"][keep], found["_hash"][keep], strict=True)], "doc_id long, _hash long")
    return (rows.join(F.broadcast(chosen), ["doc_id", "_hash"]).dropDuplicates(["doc_id", "_hash"])
            .withColumn("_fold", fold(F.col("doc_id"))).select("doc_id", "_text", "_label", "_fold"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = 6000,
        max_chars: int = 8_000_000):
    """Train on a bounded sample: at most ``max_rows`` labelled rows and ``max_chars`` characters.

    A single labelled text of more than ``max_chars`` is scored, but can't be in the sample.
    """
    rows = labelled_sample(docs, labels, label, max_rows, max_chars).orderBy("doc_id").toPandas()
    return train(rows["_text"].tolist(), rows["_label"].to_numpy(dtype=np.int64),
                 (rows["_fold"] == 1).to_numpy(dtype=bool))


def score(docs: DataFrame, model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and the offending offsets of every row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, span_starts array<int>, span_ends array<int>")
    def tagged(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for s in parts:
            yield m.score([t or "" for t in s.tolist()])

    df = docs.select("doc_id", tagged(F.col(text_col)).alias("_t"))
    return df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_t.score").alias("score"),
                     (F.col("_t.score") >= threshold).cast("int").alias("predicted"),
                     F.col("_t.span_starts").alias("span_starts"), F.col("_t.span_ends").alias("span_ends"))
