"""URL filter: rules first, then a likelihood ratio of two character language models.

Rules name a host and a path prefix; the longest that fits decides.  The URLs they decide train
two character models of variable order (contexts of 0 to 4 characters, Witten-Bell smoothing
from each order to the next lower), one of the allowed, one of the blocked.  A URL without a
rule is allowed if the difference of its log-likelihoods per character reaches a threshold that
best separates decided URLs which neither model has counted.

Characters fall into 64 classes.  Every context of every URL is counted exactly, in a table that
grows with the corpus; what a block of URLs needs of it is joined to the block, once per distinct
context and character, so a common one is not shipped per occurrence.

Defined results: a null url is empty, has no host and path, no rule, and a difference of 0;
without both allowed and blocked URLs the method allows; repeated rows are judged alike; an
empty table gives an empty result; other columns do not enter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tweetlake.llm.common import ascii_lower, cut, ship

#: The rules, as verdict and host followed by the path's beginning.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
ORDERS, CLASSES = 5, 64
BINS, SPAN = 400, 4.0
BLOCK = 2000  # URLs scored together
_SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789-._~:/?#[]@!$&'()*+,;=%"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _classes() -> np.ndarray:
    table = np.arange(256) % 4 + 60
    for i, c in enumerate(_SIGNS):
        table[ord(c)] = table[ord(c.upper())] = i
    return table.astype(np.int64)


_CLASS = _classes()


def contexts(urls: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Contexts of order 0 to 4 at each character of URLs in a row, the characters' classes, the URLs' sizes.

    A URL ends with a character class of its own (59); contexts do not reach before its start.  The
    nearest character weighs most, so a context divided by 65 is that of the next lower order.
    """
    raw = [_CLASS[np.frombuffer(u.encode("utf-8", "replace"), dtype=np.uint8)] for u in urls]
    sizes = np.array([len(x) + 1 for x in raw], dtype=np.int64)
    chars = np.concatenate([np.append(x, 59) for x in raw]) if raw else np.zeros(0, np.int64)
    place = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    codes = [np.zeros(len(chars), dtype=np.int64)]
    for k in range(1, ORDERS):
        back = np.concatenate([np.zeros(k, np.int64), chars[:-k]])[:len(chars)] + 1
        codes.append(codes[-1] * 65 + np.where(place >= k, back, 0))
    return codes, chars, sizes


def grams(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each character with its longest context as one number, and the URLs' sizes."""
    codes, chars, sizes = contexts(urls)
    return codes[-1] * CLASSES + chars, sizes


def _judged(pages: DataFrame, *more: str) -> DataFrame:
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_of(host, path)
    return pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"),
                        rule.alias("rule"), verdict.alias("said"), *more)


class UrlModels:
    """counts: (gram, n0, n1) of the blocked (0) and the allowed (1); URLs that reach the threshold are allowed."""

    def __init__(self, counts: DataFrame, threshold: float = 0.0):
        self.counts, self.threshold = counts, threshold


def _differences(wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, d) of all grams wanted: log-likelihood allowed less blocked of a character after its context."""
    zero = F.lit(0).cast("long")
    both = wanted.select("gram").distinct().select("gram", zero.alias("n0"), zero.alias("n1")).union(counts)
    sums = [F.sum("n0").alias("n0"), F.sum("n1").alias("n1")]
    tables = [cut(both.groupBy("gram").agg(*sums)).select(
        F.expr(f"gram div {CLASSES}").alias("ctx"), (F.col("gram") % CLASSES).alias("char"), "n0", "n1")]
    for _ in range(1, ORDERS):
        tables.append(tables[-1].groupBy(F.expr("ctx div 65").alias("ctx"), "char").agg(*sums))
    p = None
    context = Window.partitionBy("ctx")  # at most 64 rows each
    for t in reversed(tables):
        for y in "01":
            t = (t.withColumn(f"s{y}", F.sum(f"n{y}").over(context))
                 .withColumn(f"k{y}", F.sum((F.col(f"n{y}") > 0).cast("long")).over(context)))
        if p is None:
            t = t.withColumns({"p0": F.lit(1 / CLASSES), "p1": F.lit(1 / CLASSES)})
        else:
            t = t.withColumn("low", F.expr("ctx div 65")).join(p.withColumnRenamed("ctx", "low"), ["low", "char"])
        p = t.select("ctx", "char", *[F.when(F.col(f"s{y}") > 0, (F.col(f"n{y}") + F.col(f"k{y}") * F.col(f"p{y}"))
                                             / (F.col(f"s{y}") + F.col(f"k{y}"))).otherwise(F.col(f"p{y}")).alias(f"p{y}") for y in "01"])
    return p.select((F.col("ctx") * CLASSES + F.col("char")).alias("gram"), (F.log("p1") - F.log("p0")).alias("d"))


def _scored(pages: DataFrame, model: UrlModels) -> DataFrame:
    """page_id, url and score (log-likelihood difference per character, the end included) of every row."""
    blocks = 1 + pages.count() // BLOCK
    kind = pages.schema["page_id"].dataType
    # Ids as text: pandas would turn a column of longs and nulls into doubles.
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.pmod(F.xxhash64("page_id", "url"), F.lit(blocks)).alias("block"))

    def needed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            codes, sizes = grams(part["url"].tolist())
            each = pd.DataFrame({"block": np.repeat(part["block"].to_numpy(dtype=np.int64), sizes), "gram": codes})
            yield each.drop_duplicates()

    def summed(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        score = np.zeros(len(left))
        if len(left):
            right = right.sort_values("gram")
            codes, sizes = grams(left["url"].tolist())
            d = right["d"].to_numpy()[np.searchsorted(right["gram"].to_numpy(), codes)]
            score = np.where(sizes > 1, np.add.reduceat(d, np.cumsum(sizes) - sizes) / sizes, 0.0)
        return pd.DataFrame({"page_id": left["page_id"], "url": left["url"], "score": score})

    wanted = cut(rows.select("block", "url").mapInPandas(needed, "block long, gram long").distinct())
    given = wanted.join(_differences(wanted, model.counts), "gram")
    out = rows.groupBy("block").cogroup(given.groupBy("block")).applyInPandas(summed, "page_id string, url string, score double")
    return out.withColumn("page_id", F.col("page_id").cast(kind))


def fit(pages: DataFrame) -> UrlModels | None:
    """Both models and the threshold from all URLs that a rule decides."""
    ship(pages.sparkSession)
    apart = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    known = _judged(pages).where("said IS NOT NULL").withColumn("y", (F.col("said") == "allow").cast("int"))

    def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for y in (0, 1):
                found, n = np.unique(grams(part["url"][part["y"] == y].tolist())[0], return_counts=True)
                yield pd.DataFrame({"gram": found, "n0": n * (1 - y), "n1": n * y})

    counts = cut(known.where(~apart).select("url", "y").mapInPandas(counted, "gram long, n0 long, n1 long")
                 .groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    total = counts.agg(F.sum("n0"), F.sum("n1")).first()
    if not (total[0] and total[1]):
        return None
    model = UrlModels(counts)
    scored = _judged(_scored(known.where(apart).select("page_id", "url"), model), "score")
    at = F.least(F.greatest(F.floor((F.col("score") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    bins = (scored.select((F.col("said") == "allow").cast("int").alias("y"), at.alias("bin"))
            .groupBy("y", "bin").agg(F.count(F.lit(1)).alias("n")).collect())
    hist = np.zeros((2, BINS))
    for r in bins:
        hist[r["y"], r["bin"]] += r["n"]
    if hist[0].any() and hist[1].any():
        below = np.concatenate([[0], np.cumsum(hist[0])]) / hist[0].sum()  # blocked under each edge
        above = 1 - np.concatenate([[0], np.cumsum(hist[1])]) / hist[1].sum()
        edges = np.linspace(-SPAN, SPAN, BINS + 1)
        good = below + above
        best = np.flatnonzero(good >= good.max() - 1e-12)
        model.threshold = float(edges[best[np.abs(edges[best]).argmin()]])
    return model


def judge(pages: DataFrame, model: UrlModels | None) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row."""
    ship(pages.sparkSession)
    scored = pages.withColumn("score", F.lit(0.0)) if model is None else _scored(pages, model)
    least = 0.0 if model is None else model.threshold
    return _judged(scored, "score").select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(F.col("score") >= least, F.lit("allow")).otherwise("block")).alias("verdict"), "score")
