"""How far the sources of a language stand apart, over a minimal acyclic transducer vocabulary.

1. One scan counts, per language, the documents of every term; terms in at least ``least_docs``
   of them are kept and numbered in byte order within their language.
2. Runs of at most ``SEGMENT`` kept terms are built into minimal transducers, one group each
   (``transducer``); a term's ordinal is its segment's first ordinal plus the transducer's output.
3. A second scan streams every text through the transducers and counts (language, source,
   ordinal).  Workers hold transducers of at most ``limit_bytes`` at a time; a larger vocabulary
   is streamed in as many scans as it has such portions, so no term is left out.
4. Probabilities and divergences are whole numbers.  A pair of sources is summed over blocks of
   ordinals, each block holding every source of the language, and terms are ranked by value and
   ordinal, which is their byte order.

Defined results: null text, lang and source are ''; a row is a document, so repeated rows count
each for itself; a language without kept terms has pairs of value 0 and no term rows; a
language of one source has no pairs; an empty table gives an empty result; other columns do not
enter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tweetlake.llm import transducer
from tweetlake.llm.common import ascii_lower, cut, remember, ship
from tweetlake.operators.indexing import with_index

#: Fixed value: a term's characters, ASCII letters and everything beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
SEGMENT, BLOCK, CHUNK = 1 << 16, 2048, 1 << 22
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IN_TERM = (_LOWER >= 128) | ((_LOWER >= ord("a")) & (_LOWER <= ord("z")))
_LOADED: dict[str, dict] = {}


def _texts(docs: DataFrame) -> DataFrame:
    none = F.lit("")
    return docs.select(*[F.coalesce(F.col(c).cast("string"), none).alias(c) for c in ("lang", "source", "text")])


def kept_terms(texts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, ordinal) of the terms in at least ``least_docs`` documents of their language."""
    terms = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0)))
    kept = (texts.select("lang", F.explode(terms).alias("term")).groupBy("lang", "term")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_docs).select("lang", "term"))
    placed = with_index(kept, [F.col("lang"), F.col("term")], "place")
    first = placed.groupBy("lang").agg(F.min("place").alias("_first"))
    return placed.join(first, "lang").select("lang", "term", (F.col("place") - F.col("_first")).alias("ordinal"))


def _build(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("ordinal")
    made = transducer.build([t.encode() for t in part["term"]])
    return pd.DataFrame({"lang": part["lang"].iloc[:1], "first": part["ordinal"].iloc[:1], "body": [made.to_bytes()]})


def transducers(vocabulary: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(lang, first, body): a minimal transducer for every run of ``segment`` ordinals."""
    part = F.expr(f"ordinal div {int(segment)}").alias("part")
    return vocabulary.groupBy("lang", part).applyInPandas(_build, "lang string, first long, body binary")


def _portions(segments: DataFrame, limit_bytes: int) -> Iterator[list]:
    """Segments in portions of at most ``limit_bytes`` (one segment at least), one at a time."""
    held, size = [], 0
    for row in segments.orderBy("lang", "first").toLocalIterator():
        if held and size + len(row.body) > limit_bytes:
            yield held
            held, size = [], 0
        held.append((row.lang, row.first, bytes(row.body)))
        size += len(row.body)
    if held:
        yield held


class _Tally:
    """Counts by (group, ordinal), merged whenever many have gathered and given out when they fill ``most``."""

    def __init__(self, most: int = 1 << 20):
        self.groups: dict[tuple[str, str], int] = {}
        self.keys, self.counts, self.loose, self.most = np.zeros(0, np.int64), np.zeros(0, np.int64), [], most
        self.size = 0

    def number(self, lang: str, source: str) -> int:
        return self.groups.setdefault((lang, source), len(self.groups))

    def add(self, group: np.ndarray, ordinal: np.ndarray) -> None:
        keys, counts = np.unique((group << 40) | ordinal, return_counts=True)
        self.loose.append((keys, counts))
        self.size += len(keys)
        if self.size > self.most:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.loose)])
        counts = np.concatenate([self.counts, *(c for _, c in self.loose)])
        self.keys, at = np.unique(keys, return_inverse=True)
        self.counts = np.zeros(len(self.keys), np.int64)
        np.add.at(self.counts, at, counts)
        self.loose, self.size = [], 0

    def full(self) -> bool:
        return len(self.keys) > self.most

    def rows(self) -> pa.RecordBatch:
        self.merge()
        names = list(self.groups)
        group = self.keys >> 40
        out = pa.RecordBatch.from_arrays(
            [pa.array([names[g][0] for g in group.tolist()], pa.string()), pa.array([names[g][1] for g in group.tolist()], pa.string()),
             pa.array(self.keys & ((1 << 40) - 1)), pa.array(self.counts)], ["lang", "source", "ordinal", "n"])
        self.groups, self.keys, self.counts = {}, self.keys[:0], self.counts[:0]
        return out


def _runs(data: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and lengths of all words of a buffer of texts, in portions cut between words."""
    fresh = np.zeros(len(data) + 1, bool)
    fresh[begins] = True
    fresh[len(data)] = True
    at = 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data) and _IN_TERM[data[end]] and not fresh[end]:
            end += 1
        inside = _IN_TERM[data[at:end]]
        edge = fresh[at:end + 1].copy()
        edge[-1] = True
        starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
        ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
        yield at + starts, ends - starts
        at = end


def _stream(batch: pa.RecordBatch, segments: dict[str, list], tally: _Tally) -> None:
    """Walk every text of a batch through the transducers of its language."""
    text = batch.column("text").cast(pa.large_string())
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    where = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    if len(text) == 0 or where[-1] == where[0]:
        return
    data = _LOWER[np.frombuffer(text.buffers()[2], np.uint8)[where[0]:where[-1]]]
    begins = where - where[0]
    langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
    group = np.array([tally.number(x, y) for x, y in zip(langs, sources)], np.int64)
    names = {x: i for i, x in enumerate(dict.fromkeys(langs))}
    tongue = np.array([names[x] for x in langs])
    for starts, lengths in _runs(data, begins[:-1]):
        row = np.searchsorted(begins, starts, "right") - 1
        for lang, number in names.items():
            mine = np.flatnonzero(tongue[row] == number)
            if not len(mine) or lang not in segments:
                continue
            key = transducer.heads(data, starts[mine], lengths[mine]) if len(segments[lang]) > 1 else None
            for first, t in segments[lang]:
                at = mine if key is None else mine[(key >= np.uint64(t.low)) & (key <= np.uint64(t.high))]
                ordinal = t.ordinals(data, starts[at], lengths[at])
                hit = ordinal >= 0
                tally.add(group[row[at[hit]]], ordinal[hit] + first)


def recount(texts: DataFrame, segments: DataFrame, limit_bytes: int = 1 << 26) -> DataFrame:
    """(lang, source, ordinal, n) of every kept term that occurs in a source, n its occurrences."""
    spark = texts.sparkSession
    ship(spark)
    schema = "lang string, source string, ordinal long, n long"
    parts = []
    for portion in _portions(segments, limit_bytes):
        held = spark.sparkContext.broadcast(portion)

        def counted(batches: Iterator[pa.RecordBatch], held=held, name=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            remember("source_audit", _LOADED)
            if name not in _LOADED:
                _LOADED.clear()
                loaded: dict[str, list] = {}
                for lang, first, body in held.value:
                    loaded.setdefault(lang, []).append((first, transducer.Transducer.from_bytes(body)))
                _LOADED[name] = loaded
            tally = _Tally()
            for batch in batches:
                _stream(batch, _LOADED[name], tally)
                if tally.full():
                    yield tally.rows()
            yield tally.rows()

        langs = sorted({lang for lang, _, _ in portion})
        scanned = texts.where(F.col("lang").isin(langs)).mapInArrow(counted, schema)
        parts.append(cut(scanned.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))))
        held.unpersist()
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _share(count: str, total: str, terms: str = "terms") -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)); the product outgrows 64 bits."""
    return F.expr(f"1 + (CAST({count} + 2 AS DECIMAL(20,0)) * {SCALE}) div ({total} + 2 * {terms})")


def _pair_sums(key: tuple, cells: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Of one block of ordinals: the sum of f for every pair of the language's sources."""
    names = groups["source"].tolist()
    place = {s: i for i, s in enumerate(names)}
    ordinals, row = np.unique(cells["ordinal"].to_numpy(), return_inverse=True)
    column = cells["source"].map(place).to_numpy()
    rest = groups["rest"].to_numpy(np.int64)
    p = np.tile(rest, (len(ordinals), 1)) if len(ordinals) else np.zeros((0, len(names)), np.int64)
    p[row, column] = cells["p"].to_numpy(np.int64)
    out = []
    some = max(1, (1 << 20) // max(1, len(names)))
    for a in range(len(names) - 1):
        total = np.zeros(len(names) - a - 1, np.int64)
        for i in range(0, len(p), some):
            x, y = p[i:i + some, a:a + 1], p[i:i + some, a + 1:]
            total += ((x - y) * (x - y) // (x + y)).sum(axis=0)
        out.append(pd.DataFrame({"lang": key[0], "one": names[a], "other": names[a + 1:], "value": total}))
    return pd.concat(out) if out else pd.DataFrame({"lang": [], "one": [], "other": [], "value": []})


def audit(docs: DataFrame, least_docs: int = 10, best: int = 10, limit_bytes: int = 1 << 26) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` for every other source of the language,
    part `term` for the ``best`` terms that a source uses more than its language does."""
    texts = _texts(docs)
    ship(docs.sparkSession)
    vocabulary = cut(kept_terms(texts, least_docs))
    cells = recount(texts, cut(transducers(vocabulary)), limit_bytes)
    sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    found = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row per source: every later step joins these small tables again.
    groups = cut(texts.select("lang", "source").distinct().join(found, ["lang", "source"], "left").join(sizes, "lang", "left")
                 .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms")))
    whole = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))

    filled = groups.where("terms > 0").withColumn("rest", _share("0", "total"))
    shares = (cells.join(filled, ["lang", "source"])
              .select("lang", "source", "ordinal", "n", _share("n", "total").alias("p")))

    # Pairs: blocks of ordinals, each with all sources of its language.
    blocks = sizes.select("lang", F.explode(F.sequence(F.lit(0), F.expr(f"(terms - 1) div {BLOCK}"))).alias("block"))
    left = shares.withColumn("block", F.expr(f"ordinal div {BLOCK}")).groupBy("lang", "block")
    right = blocks.join(filled.select("lang", "source", "rest"), "lang").groupBy("lang", "block")
    sums = (left.cogroup(right).applyInPandas(_pair_sums, "lang string, one string, other string, value long")
            .groupBy("lang", "one", "other").agg(F.sum("value").alias("value")))
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
                                                 F.struct(F.col("other").alias("source"), F.col("one").alias("item")))).alias("e"), "value")
    others = groups.where("terms = 0").select("lang", "source")
    empty = others.join(others.withColumnRenamed("source", "item"), "lang").where("source <> item")
    pairs = both.select("lang", "e.source", "e.item", "value").unionByName(empty.withColumn("value", F.lit(0).cast("long")))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))

    # Terms: against the whole language; the ordinal breaks ties.
    every = (cells.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n")).join(whole, "lang").join(sizes, "lang")
             .select("lang", "ordinal", _share("lang_n", "lang_total").alias("q")))
    p, q = F.col("p"), F.col("q")
    above = (shares.join(every, ["lang", "ordinal"]).where(p > q)
             .select("lang", "source", "ordinal", F.expr("((p - q) * (p - q)) div (p + q)").alias("value")))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    top = above.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= best)
    terms = (top.join(vocabulary, ["lang", "ordinal"])
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))
    return pairs.unionByName(terms)
