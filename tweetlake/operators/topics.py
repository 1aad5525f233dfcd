"""Topic models.

EM runs on the long table ``(doc_number, term_id, value)``, packed once into cells (a short run of
documents with their terms) and dealt by blocks (runs of documents) into a bucketed table, so entries
never move again.  An iteration sends every block the weights of the terms it holds, shares out each
entry over the topics and sends back one sum for each of these terms; what moves is a block's distinct
terms, not its entries.  Term weights lie in dense runs of terms.  The driver keeps one number per topic.

A task reads a block as a stream, first its weights and then cell by cell, in batches of a few megabytes:
it holds the weights and sums of the block's terms and one batch, not the block.

``fit_lda`` is ``pyspark.ml``'s own LDA, for its online optimiser or a model object to save.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetlake.session import ensure_checkpoint_dir, scratch_path, ship_package

# Documents and terms of a block, cells of a block of documents, entries that a block is to hold.
DOCS, TERMS, CELLS, ENTRIES = 1 << 16, 1 << 16, 16, 1 << 25
# Entries shared out at once, which stay in a core's cache.
CHUNK = 1 << 15
# Rows of three numbers go to Python without a look at the bytes of a batch after each; a join with a dictionary
# whose parts are small sorts neither side.
PACKING = {"spark.sql.execution.arrow.maxBytesPerBatch": "2147483647b", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m"}
# Rows of megabytes, cells and weights, go to Python a few at a time.
SHARING = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "4"}
# Files of such rows: a page for each and row groups of about 8 MB, which are what a writer or reader holds; by default
# Parquet looks at sizes after a hundred rows.
FILES = {"parquet.page.row.count.limit": "1", "parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(1 << 23)}
CELL = "dblock long, cell long, terms binary, counts binary, d binary, n binary"
WEIGHTS = "dblock long, kind string, block long, at binary, w binary"
ASKED = "dblock long, tblock long, at binary"
SUMS = "kind string, dblock long, block long, at binary, w binary"


class TopicModel(NamedTuple):
    terms: DataFrame  # (term_id, weights): expected occurrences of the term in each topic
    docs: DataFrame  # (doc_number, weights): expected words of the document from each topic
    k: int
    vocab_size: int


def blocks_of(docs: DataFrame, tokens_col: str = "tokens") -> dict[str, int]:
    """``fit_topics``' sizes for numbered documents of distinct tokens: blocks of about ``ENTRIES`` entries."""
    n_docs, n_entries = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(tokens_col)), F.lit(0))).first()
    return {"docs_each": max(1, ENTRIES * max(1, n_docs) // max(1, n_entries)), "n_docs": n_docs}


def _cell_docs(docs_each: int) -> int:
    return min(1 << 16, -(-docs_each // CELLS))


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session's settings for the jobs of a ``with`` block."""
    were = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in were.items():
            spark.conf.set(k, v)


def _cells_each(docs_each: int) -> int:
    return -(-docs_each // _cell_docs(docs_each))


def _packed(docs_each: int) -> Callable[[pa.Table], pa.Table]:
    """A cell's entries by term: its terms, their numbers of entries, and each entry's document; a value
    that all entries share is kept once."""
    def run(part: pa.Table) -> pa.Table:
        at, n = part["at"].to_numpy(), part["value"].to_numpy()
        if (n == n[0]).all():
            at, n = np.sort(at), n[:1]
        else:
            order = np.argsort(at, kind="stable")
            at, n = at[order], n[order]
        terms = at >> 16
        starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        dblock, cell = divmod(part["cell"][0].as_py(), _cells_each(docs_each))
        raw = lambda x, kind: [x.astype(kind).tobytes()]
        return pa.table({"dblock": [dblock], "cell": [cell], "terms": raw(terms[starts], "<i8"), "counts": raw(np.diff(starts, append=len(at)), "<i4"),
                         "d": raw(at & 0xFFFF, "<u2"), "n": raw(n, "<f8")})
    return run


def _cells(entries: DataFrame, docs_each: int) -> DataFrame:
    small = _cell_docs(docs_each)
    # One number for the cell and one for term and document, so rows are short and sorted by one number.
    place = entries.select(
        F.expr(f"doc_number div {docs_each} * {_cells_each(docs_each)} + doc_number % {docs_each} div {small}").alias("cell"),
        F.expr(f"shiftleft(term_id, 16) + doc_number % {docs_each} % {small}").alias("at"), F.col("value").cast("double"))
    # As many partitions as the session says: merged ones would not be sorted in memory.
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return place.repartition(parts, "cell").groupBy("cell").applyInArrow(_packed(docs_each), CELL)


def _parts(terms: np.ndarray, terms_each: int) -> Iterator[tuple[int, slice]]:
    """The runs of sorted terms that lie in one block of terms each."""
    blocks, starts = np.unique(terms // terms_each, return_index=True)
    for block, lo, hi in zip(blocks.tolist(), starts, [*starts[1:], len(terms)]):
        yield block, slice(lo, hi)


def _at(terms_each: int) -> str:
    """How a term's place in its block of terms is stored."""
    return "<u2" if terms_each <= 1 << 16 else "<i4"


def _rows(schema: str, *columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.record_batch([pa.array(x, kinds[kind]) for x, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def _numbers(values: pa.Array, i: int, kind: str) -> np.ndarray:
    return np.frombuffer(values[i].as_buffer(), kind)


def _asked(terms_each: int):
    """The terms of a block of documents, by blocks of terms."""
    def run(cells: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, dblock = [], None
        for batch in cells:
            for i in range(batch.num_rows):
                dblock = batch["dblock"][i].as_py()
                held.append(_numbers(batch["terms"], i, "<i8").copy())
        terms = np.unique(np.concatenate(held))
        for block, some in _parts(terms, terms_each):
            yield _rows(ASKED, [dblock], [block], [(terms[some] % terms_each).astype(_at(terms_each)).tobytes()])
    return run


def _answered(k: int, terms_each: int):
    """The weights of the terms that a block of documents asked for."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                at = part["at"][i].as_py()
                w = _numbers(part["w"], i, "<f8").reshape(-1, k)[np.frombuffer(at, _at(terms_each))]
                yield _rows(WEIGHTS, [part["dblock"][i].as_py()], ["t"], [part["tblock"][i].as_py()], [at], [w.tobytes()])
    return run


def _start(doc: np.ndarray, term: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Random shares of each entry, drawn from its numbers: the same in every attempt of a task."""
    x = (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (term.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    x = x[:, None] + np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed)
    for shift in (30, 27):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 + 1e-12


def _share_cell(own: np.ndarray, counts: np.ndarray, d: np.ndarray, n: np.ndarray, first: Callable | None, of_terms: np.ndarray | None,
                of_docs: np.ndarray | None, sums: np.ndarray, at: np.ndarray, small: int) -> np.ndarray:
    """Shares out a cell's entries, some terms at a time, adds to the sums (by topic) of its terms, which lie ``at``
    these places, and returns its documents' sums."""
    k = len(sums)
    by_doc, ends = np.zeros((k, small)), np.cumsum(counts)
    cuts = np.unique(np.searchsorted(ends, np.arange(CHUNK, ends[-1], CHUNK)))
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ends)]):
        if lo == hi:
            continue
        begin, end, many, place = ends[lo] - counts[lo], ends[hi - 1], counts[lo:hi], at[lo:hi]
        doc = d[begin:end].astype(np.intp)
        if of_terms is None:
            g = list(first(doc, np.repeat(own[lo:hi], many)).T)
        else:
            g = [np.repeat(of_terms[j][place], many) for j in range(k)]
            for j in range(k):
                g[j] *= of_docs[j][doc]
        total = g[0] + g[1] if k > 1 else g[0].copy()
        for x in g[2:]:
            total += x
        np.divide(n if len(n) == 1 else n[begin:end], total, out=total)
        starts = ends[lo:hi] - many - begin
        for j in range(k):
            x = g[j] * total
            sums[j][place] += np.add.reduceat(x, starts)
            by_doc[j] += np.bincount(doc, x, minlength=small)
    return by_doc


def _shared_out(k: int, docs_each: int, terms_each: int, seed: int, totals: np.ndarray | None, vocab_size: int):
    """An iteration on one block of documents: the weights of its terms, then its cells, each with those of its
    documents; without totals the first, random one."""
    alpha, eta, small = 50.0 / k + 1.0, 1.1, _cell_docs(docs_each)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, sums, terms, of_terms = [], None, None, None
        for batch in rows:
            for i in range(batch.num_rows):
                if batch["cell"][i].as_py() < 0:
                    if batch["at"][i].is_valid:  # else a block without entries
                        w = None if totals is None else _numbers(batch["w"], i, "<f8").reshape(-1, k).T
                        asked.append((batch["block"][i].as_py(), _numbers(batch["at"], i, _at(terms_each)).astype(np.int64), w))
                        if w is not None:
                            asked[-1] = (*asked[-1][:2], (w + (eta - 1)) / (totals + vocab_size * (eta - 1))[:, None])
                    continue
                if sums is None:
                    if not asked:
                        raise ValueError("a block's cells came before its weights")
                    asked.sort(key=lambda x: x[0])
                    terms = np.concatenate([block * terms_each + at for block, at, _ in asked])
                    of_terms = None if totals is None else np.concatenate([w for _, _, w in asked], axis=1)
                    asked, sums = None, np.zeros((k, len(terms)))
                dblock, cell, own = batch["dblock"][i].as_py(), batch["cell"][i].as_py(), _numbers(batch["terms"], i, "<i8")
                first = of_docs = None
                if totals is None:
                    begin = dblock * docs_each + cell * small
                    first = lambda doc, term: _start(doc + begin, term, k, seed)  # noqa: E731, B023
                else:
                    of_docs = np.ascontiguousarray(_numbers(batch["w"], i, "<f8").reshape(-1, k).T + (alpha - 1))
                by_doc = _share_cell(own, _numbers(batch["counts"], i, "<i4"), _numbers(batch["d"], i, "<u2"), _numbers(batch["n"], i, "<f8"),
                                     first, of_terms, of_docs, sums, np.searchsorted(terms, own), small)
                yield _rows(SUMS, ["d"], [dblock], [cell], [None], [np.ascontiguousarray(by_doc.T).tobytes()])
        of_terms = None
        if sums is not None:
            for block, some in _parts(terms, terms_each):
                yield _rows(SUMS, ["t"], [None], [block], [(terms[some] % terms_each).astype(_at(terms_each)).tobytes()], [np.ascontiguousarray(sums[:, some].T).tobytes()])

    return run


def _added(k: int, terms_each: int):
    """Sums of sorted rows, one block of terms at a time, with its totals by topic; documents' rows pass."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, total = None, None

        def row() -> pd.DataFrame:
            return pd.DataFrame({"kind": ["t"], "dblock": pd.array([None], "Int64"), "block": [block], "w": [total.tobytes()], "by_topic": [total.sum(0)]})

        for part in parts:
            docs = part[part["kind"] == "d"]
            if len(docs):
                yield pd.DataFrame({"kind": "d", "dblock": docs["dblock"].astype("Int64"), "block": docs["block"], "w": docs["w"], "by_topic": None})
            part = part[part["kind"] == "t"]
            for at_block, at, w in zip(part["block"], part["at"], part["w"]):
                if at_block != block:
                    if block is not None:
                        yield row()
                    block, total = at_block, np.zeros((terms_each, k))
                total[np.frombuffer(at, _at(terms_each))] += np.frombuffer(w).reshape(-1, k)
        if block is not None:
            yield row()

    return run


def _rows_of(blocks: DataFrame, start: str, name: str, k: int) -> DataFrame:
    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for first, w in zip(part["first"], part["w"]):
                x = np.frombuffer(w).reshape(-1, k)
                at = np.flatnonzero(x.any(1))
                for some in np.array_split(at, 1 + len(at) // 8192):
                    yield pd.DataFrame({name: first + some, "weights": list(x[some])})
    return blocks.select(F.expr(start).alias("first"), "w").mapInPandas(spread, f"{name} long, weights array<double>")


def fit_topics(entries: DataFrame, vocab_size: int, k: int = 3, max_iter: int = 20, seed: int = 11,
               docs_each: int = DOCS, terms_each: int = TERMS, n_docs: int | None = None) -> TopicModel:
    """M6: ``entries(doc_number, term_id, value)``, numbered densely from 0, fitted by EM with the
    concentrations 50 / k + 1 (documents) and 1.1 (topics).  Per term, and per document, the weights
    over the topics add up to its total value; what has no entries has no row.  ``docs_each`` documents
    are a task's block (``block_docs``); ``n_docs``, if known, says how many blocks there are."""
    spark = entries.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "topics")
    table = f"topic_cells_{os.path.basename(path)[-32:]}"
    if n_docs is None:
        n_docs = 1 + (entries.agg(F.max("doc_number")).first()[0] or 0)
    n_blocks = -(-max(1, n_docs) // docs_each)
    buckets = 4 * n_blocks
    # Each block begins with a row for the weights of its terms.
    begins = spark.range(0, n_blocks, 1, 1).select(F.col("id").alias("dblock"), F.lit(-1).cast("long").alias("cell"),
                                          *[F.lit(None).cast("binary").alias(x) for x in ("terms", "counts", "d", "n")])
    try:
        with _set(spark, PACKING):
            # A task holds a few cells and writes them into their buckets, so they are not shuffled once more.
            (_cells(entries, docs_each).unionByName(begins).write.format("parquet").options(**FILES).option("path", f"{path}/cells")
             .bucketBy(buckets, "dblock").saveAsTable(table))
        with _set(spark, SHARING):
            cells = spark.table(table)
            (cells.where("cell >= 0").select("dblock", "terms").groupBy("dblock").applyInArrow(_asked(terms_each), ASKED)
             .write.options(**FILES).parquet(f"{path}/asked"))
            asked = spark.read.schema(ASKED).parquet(f"{path}/asked")
            blocks, totals = None, None
            for i in range(max_iter + 1):
                if blocks is None:
                    weights = asked.select("dblock", F.lit("t").alias("kind"), F.col("tblock").alias("block"), "at", F.lit(None).cast("binary").alias("w"))
                else:
                    now = blocks.where("kind = 't'").select(F.col("block").alias("tblock"), "w")
                    weights = (asked.join(now, "tblock").mapInArrow(_answered(k, terms_each), WEIGHTS)
                               .unionByName(blocks.where("kind = 'd'").select("dblock", "kind", "block", F.lit(None).cast("binary").alias("at"), "w")))
                # Joined by block alone, as the cells are dealt: by equality of cells too they would move.
                here = weights.withColumnRenamed("dblock", "of").hint("merge")
                with_weights = cells.join(here, F.expr("dblock = of and case when kind = 't' then cell < 0 else cell - block = 0 end"), "left")
                sums = (with_weights.select("dblock", "cell", "terms", "counts", "d", "n", "block", "at", "w").sortWithinPartitions("dblock", "cell")
                        .groupBy("dblock").applyInArrow(_shared_out(k, docs_each, terms_each, seed, totals, vocab_size), SUMS))
                added = "kind string, dblock long, block long, w binary, by_topic array<double>"
                (sums.repartition("kind", "dblock", "block").sortWithinPartitions("kind", "block")
                 .mapInPandas(_added(k, terms_each), added).write.options(**FILES).parquet(f"{path}/weights-{i}"))
                blocks = spark.read.schema(added).parquet(f"{path}/weights-{i}")
                if i < max_iter:
                    # One row per block of terms.
                    totals = sum((np.array(r.by_topic) for r in blocks.where("kind = 't'").select("by_topic").collect()), np.zeros(k))
    finally:
        # The table is external: its files stay in the scratch folder.
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    terms = _rows_of(blocks.where("kind = 't'"), f"block * {terms_each}", "term_id", k)
    docs = _rows_of(blocks.where("kind = 'd'"), f"dblock * {docs_each} + block * {_cell_docs(docs_each)}", "doc_number", k)
    return TopicModel(terms, docs, k, vocab_size)


def row_vectors(rows: DataFrame, size: int, doc_number: str = "doc_number", index_col: str = "indices") -> DataFrame:
    """J2 rows ``(doc_number, indices)`` as ``(label = doc_number, features)`` for ``fit_lda``."""
    spark = rows.sparkSession
    path = scratch_path(spark, "row-vectors")
    cells = F.transform(F.sort_array(index_col), lambda i: F.concat((i + 1).cast("string"), F.lit(":1.0")))
    rows.select(F.concat_ws(" ", F.col(doc_number).cast("string"), F.array_join(cells, " ")).alias("value")).write.text(path)
    return spark.read.format("libsvm").option("numFeatures", str(max(1, size))).load(path)


def fit_lda(vectors: DataFrame, k: int = 3, max_iter: int = 20, seed: int = 11,
            optimizer: str = "em", checkpoint_interval: int = 10, features_col: str = "features") -> LDAModel:
    """M6 by ``pyspark.ml``."""
    ensure_checkpoint_dir(vectors.sparkSession)
    lda = LDA(k=k, maxIter=max_iter, seed=seed, optimizer=optimizer,
              checkpointInterval=checkpoint_interval, featuresCol=features_col)
    return lda.fit(vectors)


def topic_terms(model: TopicModel, dictionary: DataFrame | None = None, token_col: str = "token",
                index_col: str = "term_id") -> DataFrame:
    """M7 + D16: long table ``(term_id[, term], topic, weight, weight_normalised)``; raw
    expected counts, and the weight normalised within the topic."""
    long = model.terms.select("term_id", F.posexplode("weights").alias("topic", "weight"))
    totals = long.groupBy("topic").agg(F.sum("weight").alias("_total"))
    # One row per topic.
    long = long.join(F.broadcast(totals), "topic").withColumn("weight_normalised", F.col("weight") / F.col("_total")).drop("_total")
    if dictionary is None:
        return long
    return long.join(dictionary.select(F.col(index_col).alias("term_id"), F.col(token_col).alias("term")), "term_id")


def topic_rows(terms: DataFrame, run: int = 8192) -> DataFrame:
    """M7 text + U2: ``(topic, part, text)``; a topic's parts, one after another, are its line
    ``Topic i: w w ...`` with the weights in term order (no blank seed row, D15).  A part holds ``run``
    terms, so no row, group or task is as long as the dictionary."""
    rows = (terms.groupBy("topic", F.expr(f"term_id div {int(run)}").alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct("term_id", "weight"))).alias("_w")))
    begins = F.when(F.col("part") == 0, F.concat(F.lit("Topic "), F.col("topic").cast("string"), F.lit(": "))).otherwise(F.lit(" "))
    return rows.select("topic", "part", F.concat(begins, F.array_join(F.transform("_w", lambda s: s["weight"].cast("string")), " ")).alias("text"))


def write_topic_rows(rows: DataFrame, path: str) -> None:
    """The parts as text, sorted by topic and part over all files: read in file order they are the topics'
    lines, cut at the parts' ends."""
    rows.repartitionByRange("topic", "part").sortWithinPartitions("topic", "part").select(
        F.concat_ws("\t", F.col("topic").cast("string"), F.col("part").cast("string"), "text").alias("value")).write.text(path)


def topic_distributions(model: TopicModel, docs: DataFrame, doc_number: str = "doc_number") -> DataFrame:
    """M8: ``docs`` with ``topicDistribution``, the fitted weights of every document scaled to sum 1; a
    document without terms has zeros."""
    total = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    fitted = model.docs.select(F.col("doc_number").alias("_number"), F.transform("weights", lambda x: x / total).alias("_share"))
    zeros = F.array_repeat(F.lit(0.0), model.k)
    return (docs.join(fitted, F.col(doc_number) == F.col("_number"), "left")
            .select(*docs.columns, F.coalesce("_share", zeros).alias("topicDistribution")))
