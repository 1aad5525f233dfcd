"""Ranked lexical search by scanning documents with an Aho-Corasick automaton of all item terms.

There is no index of the documents.  The items' terms, each guarded by a blank on both sides,
make one automaton; a document is scanned with every character outside terms turned into a
blank, so a match is a whole term and overlapping guards share their blank.  Two scans read
the documents: the first gives their number, their length and each term's document frequency,
the second scores.  The automaton's outputs map to items, so a document scores all items it
touches at once, and each task keeps only the best of every item.

Items are taken in blocks of bounded items and terms, one automaton each; a larger item table
means more scans, never a larger broadcast.

Defined results: a null or empty text, or one without a term, is no document for the statistics
and scores nothing; repeated documents rank each for itself; a null doc_id comes last among
equal scores; repeated items count once, and an id with unlike texts is one item for each; items
without terms or matches give no rows; an empty table gives an empty result; other columns do
not enter.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tweetlake.llm.common import ascii_lower, cut, remember, ship
from tweetlake.operators.indexing import with_index

#: Fixed value: a term's characters, ASCII digits and letters and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What a byte of a text becomes: A-Z lower-cased, other characters outside terms a blank.
_BYTES = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
MOST_ITEMS, MOST_POSTINGS, MOST_CELLS = 4096, 1 << 20, 1 << 22
_BUILT: dict[str, object] = {}


class _Block:
    """The terms of some items and, per term, its items (CSR)."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.name = uuid.uuid4().hex
        self.items = np.array([number for number, _ in items], np.int64)
        holders: dict[str, list[int]] = {}
        for at, (_, terms) in enumerate(items):
            for t in terms:
                holders.setdefault(t, []).append(at)
        self.terms = list(holders)
        self.begin = np.cumsum([0, *map(len, holders.values())])
        self.held = np.fromiter((i for h in holders.values() for i in h), np.int64)

    def automaton(self):
        """Built once per Python worker."""
        import ahocorasick
        remember("lexical_scan", _BUILT)
        if self.name not in _BUILT:
            _BUILT.clear()
            made = ahocorasick.Automaton()
            for number, t in enumerate(self.terms):
                made.add_word(f" {t} ", number)
            made.make_automaton()
            _BUILT[self.name] = made
        return _BUILT[self.name]


def _blocks(items: DataFrame, most_items: int, most_postings: int) -> Iterator[_Block]:
    held, postings = [], 0
    for row in items.select("item", "terms").orderBy("item").toLocalIterator():
        if held and (len(held) >= most_items or postings + len(row.terms) > most_postings):
            yield _Block(held)
            held, postings = [], 0
        if row.terms:
            held.append((row.item, row.terms))
            postings += len(row.terms)
    if held:
        yield _Block(held)


def _counts(texts: pa.Array, automaton) -> Iterator[tuple[int, Counter]]:
    """Per text: its number of terms, and the occurrences of each item term by number."""
    value = itemgetter(1)
    for text in texts:
        raw = (text.as_py() or "").encode().translate(_BYTES)
        yield len(raw.split()), Counter(map(value, automaton.iter(f" {raw.decode()} ")))


def statistics(docs: DataFrame, block: _Block) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the document frequency of the block's terms."""
    held = docs.sparkSession.sparkContext.broadcast(block)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = held.value
        found = np.zeros(len(b.terms) + 2, np.int64)
        for batch in batches:
            for n, tf in _counts(batch.column("text"), b.automaton()):
                found[list(tf)] += 1
                found[-2] += n > 0
                found[-1] += n
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["at", "n"])

    rows = docs.select("text").mapInArrow(summed, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    found = np.zeros(len(block.terms) + 2, np.int64)
    for r in rows.collect():  # as many rows as the block has terms
        found[r.at] = r.n
    held.unpersist()
    return int(found[-2]), int(found[-1]), found[:-2]


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


class _Best:
    """The best documents of every item so far: higher score, then smaller id, null ids last."""

    def __init__(self, items: int, best: int):
        self.best = best
        self.bar = np.zeros(items, np.int64)  # a score must reach it
        self.rows = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]
        self.loose, self.size = [], 0

    def add(self, scores: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        at, item = np.nonzero((scores > 0) & (scores >= self.bar))
        if len(at):
            self.loose.append([item, scores[at, item], doc[at], known[at]])
            self.size += len(at)
            if self.size > (1 << 16):
                self.settle()

    def settle(self) -> list[np.ndarray]:
        item, score, doc, known = (np.concatenate(x) for x in zip(self.rows, *self.loose))
        order = np.lexsort((doc, ~known, -score, item))
        first = np.searchsorted(item[order], item[order], "left")
        order = order[np.arange(len(order)) - first < self.best]
        self.rows = [x[order] for x in (item, score, doc, known)]
        self.loose, self.size = [], 0
        n = np.bincount(self.rows[0], minlength=len(self.bar))
        last = np.cumsum(n) - 1
        self.bar = np.where(n >= self.best, self.rows[1][last], 0) if len(order) else self.bar
        return self.rows


def _spread(block: _Block, row: np.ndarray, term: np.ndarray, gain: np.ndarray, out: np.ndarray) -> None:
    """Add each (document, term) gain to every item that holds the term."""
    flat = out.reshape(-1)
    size = block.begin[term + 1] - block.begin[term]
    for some in np.array_split(np.arange(len(term)), 1 + int(size.sum()) // MOST_CELLS):
        n = size[some]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item = block.held[np.repeat(block.begin[term[some]], n) + nth]
        np.add.at(flat, np.repeat(row[some] * out.shape[1], n) + item, np.repeat(gain[some], n))


def _best_of_tasks(docs: DataFrame, block: _Block, documents: int, length: int, df: np.ndarray, best: int) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast((block, weights(df, documents)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, weight = held.value
        kept = _Best(len(b.items), best)
        some = max(1, MOST_CELLS // len(b.items))
        for batch in batches:
            for at in range(0, batch.num_rows, some):
                part = batch.slice(at, some)
                row, term, tf, m = [], [], [], []
                for i, (n, counts) in enumerate(_counts(part.column("text"), b.automaton())):
                    row += [i] * len(counts)
                    term += counts.keys()
                    tf += counts.values()
                    m.append(10 + 90 * n * documents // length)
                row, term, tf = (np.array(x, np.int64) for x in (row, term, tf))
                gain = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * np.array(m, np.int64)[row]))
                scores = np.zeros((part.num_rows, len(b.items)), np.int64)
                _spread(b, row, term, gain, scores)
                ids = part.column("doc_id")
                kept.add(scores, ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False))
        item, score, doc, known = kept.settle()
        yield pa.RecordBatch.from_arrays([pa.array(b.items[item]), pa.array(doc, mask=~known), pa.array(score)],
                                         ["item", "doc_id", "score"])

    return docs.mapInArrow(scored, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, best: int = 10, most_items: int = MOST_ITEMS,
           most_postings: int = MOST_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of every item."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    terms = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0)))
    wanted = cut(with_index(wanted.withColumn("terms", terms).select("item_id", "text", "terms"),
                            [F.col("item_id"), F.col("text")], "item").select("item", "item_id", "terms"))
    found = spark.createDataFrame([], "item long, doc_id long, score long")
    for block in _blocks(wanted, most_items, most_postings):
        documents, length, df = statistics(texts, block)
        if length:
            found = found.unionByName(_best_of_tasks(texts, block, documents, length, df, best))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return top.join(wanted.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
