"""Queries on whole dictionaries: which words stay, and what an iteration of the topic model moves."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tweetlake.operators import topics

# "the" and "you" are function words; the others are words of the dictionary.
ROWS = [(1, "I think you want new welcome, help"), (2, "the the You"), (3, None), (3, "Think first thanks the sea"), (4, "new sea")]
WORDS = {"think": 2, "want": 1, "new": 2, "welcome": 1, "help": 1, "first": 1, "thanks": 1, "sea": 2}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("few"))
    spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    return path


def _both(spark, folder, name):
    """The query's rows, and its SQL's over the same table."""
    import __spark_entry__
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    got = [tuple(r) for r in __spark_entry__.queries()[name](spark, folder).collect()]
    return sorted(got, key=str), sorted(con.execute(__spark_entry__.oracle_sql()[name]).fetchall(), key=str)


def test_lda_term_totals_keeps_words(spark, folder):
    got, sql = _both(spark, folder, "lda_term_totals")
    assert dict(got) == WORDS and got == sql


def test_lda_vocab_size_counts_words(spark, folder):
    got, sql = _both(spark, folder, "lda_vocab_size")
    assert got == sql == [(len(WORDS),)]


def test_topic_rows_keep_words(spark, folder):
    got, sql = _both(spark, folder, "topic_rows")
    assert [n for _, n in got] == [WORDS[w] for w in sorted(WORDS)] and got == sql


def test_normalise_tokens_keeps_words(spark, folder):
    got, _ = _both(spark, folder, "normalise_tokens")
    assert (1, "think want new welcome help ") in got and (3, "think first thanks sea ") in got


def test_tweet_topics_keep_words(spark, folder):
    got, _ = _both(spark, folder, "tweet_topics")
    assert got == [("1", 5, 1.0), ("2", 0, 0.0), ("3", 0, 0.0), ("3", 4, 1.0), ("4", 2, 1.0)]


def test_topics_of_uneven_values(spark):
    """Cells of several documents, values that differ, a pair met twice and numbers left out, against plain arrays."""
    rng = np.random.default_rng(8)
    rows = [(int(a), int(b), float(v)) for a, b, v in zip(rng.integers(0, 90, 900) * 2, rng.integers(0, 50, 900), rng.integers(1, 9, 900) / 2)]
    rows.append(rows[0])
    d, t, n = (np.array(x) for x in zip(*rows))
    k, of_docs, of_terms = 4, np.zeros((180, 4)), np.zeros((50, 4))
    g = topics._start(d, t, k, 2)
    for _ in range(5):
        g = g * (n / g.sum(1))[:, None]
        of_docs[:], of_terms[:] = 0, 0
        np.add.at(of_docs, d, g)
        np.add.at(of_terms, t, g)
        g = (of_terms[t] + 0.1) * (of_docs[d] + 50 / k) / (of_terms.sum(0) + 50 * 0.1)
    entries = spark.createDataFrame(rows, "doc_number long, term_id long, value double")
    for sizes in ({"docs_each": 40, "terms_each": 9}, {"docs_each": 40, "terms_each": 50, "n_docs": 180}):
        model = topics.fit_topics(entries, 50, k=k, max_iter=4, seed=2, **sizes)
        got = {r.term_id: r.weights for r in model.terms.collect()}
        assert set(got) == set(t.tolist()) and all(np.allclose(w, of_terms[i]) for i, w in got.items())
        got = {r.doc_number: r.weights for r in model.docs.collect()}
        assert set(got) == set(d.tolist()) and all(np.allclose(w, of_docs[i]) for i, w in got.items())
    assert not [x.name for x in spark.catalog.listTables() if x.name.startswith("topic_cells_")]


def test_an_iteration_moves_terms_not_entries(spark):
    """Bytes of shuffles that one more iteration writes, where every document holds a quarter of the terms."""
    entries = spark.range(4000).select(F.col("id").alias("doc_number"), F.explode(F.sequence(F.lit(0), F.lit(99))).alias("x")).select(
        "doc_number", (F.col("x") * 4 + F.pmod(F.hash("doc_number", "x"), F.lit(4))).cast("long").alias("term_id"), F.lit(1.0).alias("value"))
    sc = spark.sparkContext._jsc.sc()

    def written() -> int:
        sc.listenerBus().waitUntilEmpty()
        every = sc.statusStore().executorList(False)
        return sum(every.apply(i).totalShuffleWrite() for i in range(every.size()))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        took = []
        for n in (1, 3):
            before = written()
            topics.fit_topics(entries, 400, max_iter=n, docs_each=1000, terms_each=20)
            took.append(written() - before)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Four blocks of 400 terms and the weights of 4,000 documents; there are 400,000 entries.
    assert (took[1] - took[0]) / 2 < 800_000


def test_blocks_hold_a_number_of_entries(spark):
    docs = spark.createDataFrame([(["a", "b"],), (None,), ([],), (["a", "b"],)], "tokens array<string>")
    assert topics.blocks_of(docs) == {"docs_each": topics.ENTRIES, "n_docs": 4}
    assert topics.blocks_of(docs.limit(0)) == {"docs_each": topics.ENTRIES, "n_docs": 0}


def _block(k: int = 3, cells: int = 6, docs: int = 4, terms: int = 10):
    """A block's rows, as a task reads them: weights, then cells of ``docs`` documents that hold all terms."""
    raw = lambda x, kind: np.asarray(x).astype(kind).tobytes()
    one = lambda cell, **x: pa.record_batch([pa.array([v], kind) for v, kind in (
        (0, pa.int64()), (cell, pa.int64()), *((x.get(c), pa.binary()) for c in ("terms", "counts", "d", "n")), (0 if cell < 0 else cell, pa.int64()),
        *((x.get(c), pa.binary()) for c in ("at", "w")))], ["dblock", "cell", "terms", "counts", "d", "n", "block", "at", "w"])
    yield one(-1, at=raw(range(terms), "<u2"), w=raw(np.arange(terms * k) + 1, "<f8"))
    for c in range(cells):
        yield one(c, terms=raw(range(terms), "<i8"), counts=raw([docs] * terms, "<i4"), d=raw([*range(docs)] * terms, "<u2"), n=raw([1], "<f8"), w=raw(np.ones(docs * k), "<f8"))


def test_a_block_is_read_as_a_stream():
    """The sums of a cell's documents leave before the next cell comes, so a task never holds its block's cells."""
    read = []

    def rows():
        for x in _block():
            read.append(x["cell"][0].as_py())
            yield x

    run = topics._shared_out(3, 16 * 4, 1 << 16, 1, np.full(3, 155.0), 10)
    out = []
    for x in run(rows()):
        out += x.to_pylist()
        if out[-1]["kind"] == "d":
            assert read[-1] == out[-1]["block"] and len(read) == 2 + out[-1]["block"]
    assert [r["kind"] for r in out] == ["d"] * 6 + ["t"]
    sums = np.frombuffer(out[-1]["w"]).reshape(-1, 3)
    assert np.allclose(sums.sum(1), 24) and np.allclose(sum(np.frombuffer(r["w"]).reshape(-1, 3)[:4].sum(0) for r in out[:-1]), sums.sum(0))


def test_weights_come_before_cells():
    first, *others = _block()
    with pytest.raises(ValueError, match="before its weights"):
        list(topics._shared_out(3, 16 * 4, 1 << 16, 1, np.full(3, 155.0), 10)(iter([*others, first])))


def test_cells_lie_in_small_row_groups(spark, tmp_path):
    """What a reader of a block holds at once: row groups of a few cells, not all cells of the block."""
    # Two documents a cell; a cell's terms and counts are 3 MB and more, and random, so that they stay as large.
    entries = spark.range(4_000_000).select((F.col("id") % 32).alias("doc_number"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("term_id"), F.lit(1.0).alias("value"))
    topics._cells(entries, 32).coalesce(1).write.options(**topics.FILES).parquet(str(tmp_path / "cells"))
    groups = [f.row_group(i) for x in sorted((tmp_path / "cells").glob("*.parquet")) for f in [pq.ParquetFile(x).metadata] for i in range(f.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 16 and len(groups) > 2 and max(g.total_byte_size for g in groups) < 1 << 25


def test_columnar_numbers_are_the_same_rows(spark):
    """Rows kept as Parquet: dense numbers in the order of partitions, nulls and empty arrays kept, and less on disk."""
    from tweetlake.operators.indexing import number_rows
    rows = [(i, None if i % 7 == 0 else [f"word{j}" for j in range(i % 5)]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(5, "doc_id")
    got = number_rows(df, "n", columnar=True)
    assert sorted((r.doc_id, r.tokens) for r in got.collect()) == rows
    assert sorted(r.n for r in got.collect()) == list(range(200))
    assert [r.doc_id for r in got.orderBy("n").collect()] == [r.doc_id for r in number_rows(df, "n").orderBy("n").collect()]
