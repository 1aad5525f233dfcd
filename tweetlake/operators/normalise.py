"""Tweet text to stemmed tokens (P20).

Stemming is done once per distinct word: the words of all documents are reduced to a table of
distinct ones, stemmed there and joined back on the word.  A frequent word has one row in that
table and its documents' rows are spread like any skewed join key (``lookup_join``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetlake.functions.stem import stem_table
from tweetlake.functions.text import normalise_tokens
from tweetlake.operators.joins import lookup_join


def stemmed_tokens(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", stop_words: list[str] | None = None,
                   **join_kw) -> DataFrame:
    """``(doc_col, tokens)`` of every document: normalised words, stemmed, one copy of a stem per
    document in the order of first appearance.  ``doc_col`` names a document, and rows that share it
    are one document; null and empty texts have no tokens."""
    words = docs.select(doc_col, F.posexplode(normalise_tokens(text_col, stop_words)).alias("pos", "token"))
    hit = lookup_join(words, stem_table(words), ["token"], "inner", **join_kw)
    # A document's distinct words: bounded by its text.
    rows = hit.groupBy(doc_col).agg(F.sort_array(F.collect_list(F.struct("pos", "token", "stem"))).alias("_w"))
    tokens = F.array_distinct(F.transform("_w", lambda x: x["stem"]))
    every = docs.select(doc_col).distinct().join(rows, doc_col, "left")
    return every.select(doc_col, F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
