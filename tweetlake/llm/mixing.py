"""Mixing to target weights with soft memberships.

1. A naive Bayes classifier over hashed tokens learns domains from a bounded sample of a
   labelled table and gives every document a posterior over domains; a temperature fitted on
   rows it has not counted keeps posteriors soft.
2. Nonnegative document rates r minimise the squared gaps between expected domain token totals
   (sum of rate x tokens x posterior) and their targets, each gap relative to its domain's
   share, plus a small pull of the rates towards 1.  Projected gradient: a step sums K numbers
   over all documents on Spark; the rates themselves are not stored, as a rate follows from
   the posterior and the steps' gaps.
3. A document is taken floor(rate) times, and once more if a hash of its id falls below the
   rest.

Defined results: a null or empty text counts one token (its closing id) and has the prior as
posterior; a domain without documents can't be raised and its target stays unmet; without
labelled rows every posterior is even; repeated rows count each; an empty table gives an empty
result; other columns are kept by ``mix`` and do not enter otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tweetlake.llm.common import cut, fold, held_out, sample_rows, ship
from tweetlake.llm.quality_net import ROWS, token_rows

TARGETS = {"de": 0.2, "en": 0.5, "es": 0.15, "fr": 0.15}
PULL = 1e-4


class Posterior:
    """log P(token row | domain), log prior, temperature per token."""

    def __init__(self, logs: np.ndarray, prior: np.ndarray, temperature: float = 1.0):
        self.logs, self.prior, self.temperature = logs, prior, temperature

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors (texts x domains) and token counts."""
        z, n = np.zeros((len(texts), self.logs.shape[1])), np.ones(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            ids = token_rows(t)
            n[i] += len(ids)
            if len(ids):
                z[i] = self.logs[ids].sum(axis=0)
        z = z / self.temperature + self.prior
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True), n


def fit_posterior(docs: DataFrame, labelled: DataFrame, domains: list[str], max_rows: int = 8000) -> Posterior:
    """Learn from at most ``max_rows`` rows of ``labelled`` (doc_id, domain) that are not held out."""
    ship(docs.sparkSession)
    of = {d: i for i, d in enumerate(domains)}
    k = len(domains)
    ids = (labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.min("domain").alias("domain")))
    # At most max_rows ids: small by its parameter.
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
            .join(F.broadcast(sample_rows(ids, max_rows, F.col("doc_id"))), "doc_id")
            .select("t", "domain", (fold(F.col("doc_id")) == 1).alias("apart")))

    def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((ROWS, k), dtype=np.int64)
        docs_of = np.zeros(k, dtype=np.int64)
        for part in parts:
            for t, d in zip(part["t"], part["domain"], strict=True):
                total[:, of[d]] += np.bincount(token_rows(t), minlength=ROWS)
                docs_of[of[d]] += 1
        cells = np.flatnonzero(total)
        yield pd.DataFrame({"cell": np.concatenate([cells, ROWS * k + np.arange(k)]),
                            "n": np.concatenate([total.reshape(-1)[cells], docs_of])})

    # At most ROWS x domains cells.
    sums = (rows.where(~F.col("apart")).select("t", "domain").mapInPandas(counted, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    flat = np.zeros(ROWS * k + k)
    flat[sums["cell"].to_numpy(dtype=np.int64)] = sums["n"].to_numpy(dtype=np.float64)
    counts, n_docs = flat[:ROWS * k].reshape(ROWS, k), flat[ROWS * k:]
    if not n_docs.any():
        return Posterior(np.zeros((ROWS, k)), np.zeros(k))
    logs = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * ROWS))
    prior = np.log((n_docs + 1) / (n_docs.sum() + k))
    grid = np.geomspace(1, 64, 13)

    def losses(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            truth = np.array([of[d] for d in part["domain"]])
            out = []
            for t in grid:
                p, _ = Posterior(logs, prior, t).of(part["t"].tolist())
                out.append(float(-np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).sum()))
            yield pd.DataFrame({"step": range(len(grid)), "loss": out})

    seen = (rows.where("apart").select("t", "domain").mapInPandas(losses, "step int, loss double")
            .groupBy("step").agg(F.sum("loss").alias("loss")).collect())
    best = min(seen, key=lambda r: (r["loss"], r["step"]))["step"] if seen else 0
    return Posterior(logs, prior, float(grid[best]))


def rates_after(p: np.ndarray, steps: list[np.ndarray], share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rates after the steps' gaps, from rates of 1, and where the next gap is taken."""
    r = at = np.ones(len(p))
    weight = np.where(share > 0, 1 / np.where(share > 0, share, 1), 0)
    for number, gap in enumerate(steps, 1):
        r, before = np.maximum(0, at - (p @ (weight * gap) + PULL * (at - 1)) / (1 + PULL)), r
        # Nesterov: the gap is taken beyond the last step, in its direction.
        at = r + (number - 1) / (number + 2) * (r - before)
    return r, at


def rate_of(p: np.ndarray, steps: list[np.ndarray], share: np.ndarray) -> np.ndarray:
    return rates_after(p, steps, share)[0]


class Fitted(NamedTuple):
    steps: list[np.ndarray]  # the gap of every step
    share: np.ndarray  # of the tokens, by domain
    unmet: float  # the largest distance of a domain's share from its target that remains


def fit_rates(members: DataFrame, targets: Mapping[str, float], close: float = 1e-3, patience: int = 30) -> Fitted:
    """Accelerated projected-gradient steps over ``members`` (tokens, p) until every target is met within
    ``close`` times the largest; targets that no rates meet end the steps once ``patience`` of them have
    brought nothing, and the remaining distance is returned."""
    domains = sorted(targets)
    k = len(domains)
    want = np.array([targets[d] for d in domains], dtype=float)
    want = want / want.sum()

    def totals(steps, share):
        """Domain totals at the rates, and where the next gap is taken."""
        def summed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(2 * k)
            for part in parts:
                if len(part):
                    p, n = np.stack(part["p"].to_numpy()), part["tokens"].to_numpy()
                    total += np.concatenate([(n * r) @ p for r in rates_after(p, steps, share)])
            yield pd.DataFrame({"k": range(2 * k), "s": total})
        got = members.select("tokens", "p").mapInPandas(summed, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
        out = np.zeros(2 * k)
        for r in got:
            out[r["k"]] = r["s"]
        return out[:k], out[k:]

    now, ahead = totals([], np.ones(k))
    whole = now.sum()
    if whole <= 0:
        return Fitted([], np.zeros(k), 0.0)
    share = now / whole
    steps: list[np.ndarray] = []
    best, found = np.inf, 0
    while True:
        unmet = float(np.abs((now / whole - want)[share > 0]).max())
        if unmet < 0.99 * best:
            best, found = unmet, len(steps)
        if unmet <= close * want.max() or len(steps) - found >= patience:
            return Fitted(steps, share, unmet)
        steps.append(ahead / whole - want)
        now, ahead = totals(steps, share)


def members_of(docs: DataFrame, model: Posterior) -> DataFrame:
    """doc_id, tokens and the posterior p of every row."""
    d = _posterior_column(docs, model)
    return docs.select("doc_id", d(F.col("text")).alias("_m")).select("doc_id", "_m.tokens", "_m.p")


def _posterior_column(docs: DataFrame, model: Posterior, steps: list[np.ndarray] = (), share: np.ndarray | None = None):
    """text -> tokens, posterior and, after the steps, the rate: one pass in one Python worker."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("tokens long, p array<double>, rate double")
    def posterior(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            p, n = shared.value.of([t or "" for t in s.tolist()])
            yield pd.DataFrame({"tokens": n, "p": list(p), "rate": rate_of(p, steps, share) if len(steps) else np.ones(len(p))})

    return posterior


def _rate_column(steps: list[np.ndarray], share: np.ndarray):
    @F.pandas_udf("double")
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series(rate_of(np.stack(s.to_numpy()), steps, share) if len(s) else [], dtype="float64")

    return rate


def _copies(rate: Column, doc_id: Column) -> Column:
    chance = F.pmod(F.xxhash64(doc_id, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("int")


def rates(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """doc_id, tokens, p (in the order of the sorted domains), rate, copies and the unmet share of the targets."""
    model = fit_posterior(docs, labelled, sorted(targets))
    members = cut(members_of(docs, model))
    steps, share, unmet = fit_rates(members, targets)
    out = members.withColumn("rate", _rate_column(steps, share)(F.col("p"))).withColumn("unmet", F.lit(unmet))
    return out.withColumn("copies", _copies(F.col("rate"), F.col("doc_id")))


def mix(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """The rows of ``docs`` as often as their rates say, with all their columns."""
    model = fit_posterior(docs, labelled, sorted(targets))
    steps, share, _ = fit_rates(cut(members_of(docs, model)), targets)
    m = _posterior_column(docs, model, steps, share)
    df = docs.select(F.struct("*").alias("_doc"), m(F.col("text")).alias("_m"))
    df = df.withColumn("_copies", _copies(F.col("_m.rate"), F.col("_doc.doc_id"))).where("_copies > 0")
    return df.select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_doc.*")
