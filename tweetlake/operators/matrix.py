"""Document-term matrices.

The scalable form is the long table ``(doc_id, term_id, value)``.  Per-document rows are built
by grouping on the document, so each group is bounded by one document's distinct terms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetlake.operators.joins import lookup_join
from tweetlake.sources.sinks import sparse_text


def doc_token_pairs(doc_tokens: DataFrame, doc_col: str = "doc_id", tokens_col: str = "tokens",
                    token_col: str = "token") -> DataFrame:
    """Distinct ``(doc, token)`` pairs from an array-of-tokens column with one row per document.
    Duplicates are removed inside each row (``array_distinct``), so no shuffle is needed; if a
    document can span several rows, follow with ``.distinct()``."""
    return doc_tokens.select(doc_col, F.explode(F.array_distinct(tokens_col)).alias(token_col))


def presence_long(pairs: DataFrame, dictionary_index: DataFrame, doc_col: str = "doc_id",
                  token_col: str = "token", index_col: str = "term_id", pairs_distinct: bool = False,
                  **join_kw) -> DataFrame:
    """J3 + P23: ``(doc_id, term_id, value=1.0)`` for every dictionary term present in a doc.
    ``pairs`` holds ``(doc, token)`` rows; unless ``pairs_distinct`` says they already are
    (``doc_token_pairs`` output), duplicates are removed first, so the join sees each
    (doc, token) once -- presence, not counts."""
    pairs = pairs.select(doc_col, token_col)
    if not pairs_distinct:
        pairs = pairs.distinct()
    hit = lookup_join(pairs, dictionary_index.select(token_col, index_col), [token_col], "inner", **join_kw)
    return hit.select(doc_col, index_col, F.lit(1.0).alias("value"))


def _every_document(rows: DataFrame, docs: DataFrame | None, doc_col: str, column: str) -> DataFrame:
    """``rows`` plus, given ``docs``, an empty array for every document without a row."""
    if docs is None:
        return rows
    return (docs.select(doc_col).distinct().join(rows, doc_col, "left")
            .withColumn(column, F.coalesce(column, F.array().cast(rows.schema[column].dataType))))


def sparse_rows(presence: DataFrame, size: int, doc_col: str = "doc_id", index_col: str = "term_id",
                docs: DataFrame | None = None) -> DataFrame:
    """Per document, sorted distinct term indices (D17) and the sparse text ``(n,[i],[1.0])``;
    with ``docs``, also ``(n,[],[])`` for the documents without a dictionary term."""
    rows = presence.groupBy(doc_col).agg(F.sort_array(F.collect_set(index_col)).alias("indices"))
    rows = _every_document(rows, docs, doc_col, "indices")
    return rows.select(doc_col, F.lit(size).alias("size"), "indices",
                       sparse_text(F.lit(size), "indices").alias("vector_text"))


def dense_presence_text(presence: DataFrame, size: int, doc_col: str = "doc_id",
                        index_col: str = "term_id", docs: DataFrame | None = None) -> DataFrame:
    """J3 text form: ``" 0 1 0 ..."`` -- one entry per dictionary term, in term order; with
    ``docs`` there is a row for every document.
    The row length is the vocabulary size by definition, so use it for small vocabularies;
    ``presence_long``/``sparse_rows`` are the forms that scale."""
    rows = presence.groupBy(doc_col).agg(F.collect_set(index_col).alias("_idx"))
    rows = _every_document(rows, docs, doc_col, "_idx")
    cells = F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                        lambda i: F.when(F.array_contains(F.col("_idx"), i), F.lit(" 1")).otherwise(F.lit(" 0")))
    return rows.select(doc_col, F.array_join(cells, "").alias("row"))


def first_token_index(doc_tokens: DataFrame, dictionary_index: DataFrame, doc_col: str = "doc_id",
                      tokens_col: str = "tokens", token_col: str = "token", index_col: str = "term_id",
                      unparseable_col: str | None = None, **join_kw) -> DataFrame:
    """Each document's first token and its dictionary number (NULL when absent).
    When ``unparseable_col`` is given, rows flagged there get number 1 (the reference's rule)."""
    firsts = doc_tokens.select(doc_col, F.try_element_at(F.col(tokens_col), F.lit(1)).alias(token_col),
                               *( [unparseable_col] if unparseable_col else []))
    out = lookup_join(firsts, dictionary_index.select(token_col, index_col), [token_col], "left", **join_kw)
    if unparseable_col:
        out = out.withColumn(index_col, F.when(F.col(unparseable_col), F.lit(1).cast("bigint")).otherwise(F.col(index_col))).drop(unparseable_col)
    return out.select(doc_col, token_col, index_col)
