"""End-to-end programs: the reference's three entry points as single Spark plans.

* ``tweet_topics``  -- JSON lines -> id check -> normalised tokens -> dictionary -> index ->
  sparse rows -> LDA -> per-document topic distribution (entry 1).
* ``sentiment_points`` / ``sentiment_tree`` / ``sentiment_tree_mse`` -- five 1-D k-means discretisers on the lookup
  ("weather") table -> strict keyed lookup from the labelled ("tweet") rows -> labelled points
  with nominal features -> depth-30 regression tree -> predictions and MSE (entry 2).
* ``json_sql`` -- JSON lines with an inferred schema -> temp view -> range SQL (entry 3).
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tweetlake.functions.json import has_string_field
from tweetlake.functions.stopwords import FUNCTION_WORDS
from tweetlake.functions.text import normalise_tokens
from tweetlake.operators.cluster import discretise
from tweetlake.operators.dictionary import dictionary_from_tokens
from tweetlake.operators.evaluate import mse
from tweetlake.operators.indexing import index_tokens, number_rows
from tweetlake.operators.joins import lookup_join, strict_lookup
from tweetlake.operators.matrix import doc_token_pairs, presence_long, sparse_rows
from tweetlake.operators.models import fit_tree_regressor, labelled_points
from tweetlake.operators.sql import names_in_range, register_view
from tweetlake.operators.topics import blocks_of, fit_topics, topic_distributions
from tweetlake.plans.ml_queries import SQL_WHOLE_TOKENS
from tweetlake.plans.registry import query
from tweetlake.session import cut_lineage, held, scratch_path
from tweetlake.sources.json import read_json_lines
from tweetlake.sources.sinks import write_text
from tweetlake.sources.tables import table

# ---------------------------------------------------------------------------------------------
# Entry 1: tweets -> topics
# ---------------------------------------------------------------------------------------------

_TWEET = StructType([StructField("id", StringType()), StructField("text", StringType())])


def tweet_topics(lines, k: int = 3, max_iter: int = 20, seed: int = 11, stop_words: list[str] | None = None):
    """``lines(value)`` of tweet JSON -> ``(doc_id, tokens, n_terms, indices, topicDistribution)``.

    The dictionary is every distinct token, and the topic model is fitted on the sparse rows
    over all of it; a document's distribution is the fitted one.
    """
    valid = lines.where(has_string_field("value", "id"))
    tweets = number_rows(valid.select(F.from_json("value", _TWEET).alias("t")).select(
        F.col("t.id").alias("doc_id"), normalise_tokens("t.text", stop_words).alias("tokens")), "doc_number")
    dictionary = index_tokens(dictionary_from_tokens(tweets, "tokens"), "token", "term_id")
    size = dictionary.count()
    presence = presence_long(doc_token_pairs(tweets, "doc_number"), dictionary, "doc_number", pairs_distinct=True)
    rows = cut_lineage(sparse_rows(presence, size, "doc_number", docs=tweets).select("doc_number", "indices"))
    entries = rows.select("doc_number", F.explode("indices").alias("term_id"), F.lit(1.0).alias("value"))
    model = fit_topics(entries, size, k=k, max_iter=max_iter, seed=seed, **blocks_of(tweets))
    return (tweets.join(topic_distributions(model, rows), "doc_number")
            .select("doc_id", "tokens", F.size("indices").alias("n_terms"), "indices", "topicDistribution"))


def _documents_as_tweets(spark, d):
    docs = table(spark, d, "documents")
    return docs.select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"),
                                          F.col("text"))).alias("value"))


@query("tweet_topics", f"""
WITH n AS ({SQL_WHOLE_TOKENS.format(where='')})
SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, count(n.tok) AS n_terms,
       CASE WHEN count(n.tok) > 0 THEN 1.0 ELSE 0.0 END AS total
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id
""")
def q_tweet_topics(spark, d):
    out = tweet_topics(_documents_as_tweets(spark, d), stop_words=FUNCTION_WORDS)
    total = F.aggregate("topicDistribution", F.lit(0.0), lambda a, x: a + x)
    return out.select("doc_id", "n_terms", F.round(total, 6).alias("total"))


# ---------------------------------------------------------------------------------------------
# Entry 2: weather + tweets -> sentiment regression tree
# ---------------------------------------------------------------------------------------------

# Lookup ("weather") table: one row per order, five numeric readings with five values each.
WEATHER = ["f_cust", "f_prio", "f_yday", "f_day", "f_price"]


def _order_weather(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.pmod("o_custkey", F.lit(5)).cast("double").alias("f_cust"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).cast("double").alias("f_prio"),
        F.pmod(F.dayofyear("o_orderdate"), F.lit(5)).cast("double").alias("f_yday"),
        F.pmod(F.dayofmonth("o_orderdate"), F.lit(5)).cast("double").alias("f_day"),
        F.pmod(F.floor("o_totalprice"), F.lit(5)).cast("double").alias("f_price"))


SQL_WEATHER_GROUPS = """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity,
       o.o_custkey % 5 AS g1, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS g2,
       dayofyear(o.o_orderdate) % 5 AS g3, day(o.o_orderdate) % 5 AS g4, CAST(floor(o.o_totalprice) AS BIGINT) % 5 AS g5
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def sentiment_tree(weather, tweets, key: list[str], label: str, features: list[str], k: int = 5,
                   max_depth: int = 30, max_bins: int = 32, seed: int = 11, fit: bool = True):
    """Discretise each weather reading into ``k`` k-means clusters, give every labelled row
    its weather's cluster indices (a missing key fails the job), and fit a regression tree on
    the indices as nominal features of arity ``k``.  Returns ``(model or None, labelled points)``."""
    # Readings repeat, and every one of their values is to get a cluster of its own.
    binned = discretise(weather, features, k=k, seed=seed, output="index", suffix="_bin", compress=True)
    bins = [c + "_bin" for c in features]
    looked = strict_lookup(tweets, binned.select(*key, *bins), key, check_col=bins[0], on_missing="fail")
    pts = labelled_points(looked, label, bins, nominal_arity={b: k for b in bins},
                          keep=[c for c in tweets.columns if c != label])
    if not fit:
        return None, pts
    with held(pts) as cached:
        return fit_tree_regressor(cached, max_depth=max_depth, max_bins=max_bins, seed=seed, compress=True), pts


def _sentiment_fit(spark, d, fit: bool = True):
    tweets = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    return sentiment_tree(_order_weather(spark, d), tweets, ["o_orderkey"], "l_quantity", WEATHER, fit=fit)


@query("sentiment_points", f"""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS label,
       count(*) OVER (PARTITION BY g1, g2, g3, g4, g5) AS group_size
FROM ({SQL_WEATHER_GROUPS})
""")
def q_sentiment_points(spark, d):
    """Discretise + strict lookup + labelled points.  Cluster indices are arbitrary labels, so
    each row reports how many rows share its five indices; SQL states that from the values."""
    _, pts = _sentiment_fit(spark, d, fit=False)
    keyed = pts.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "label",
                       vector_to_array("features").alias("cell"))
    # At most 5^5 cells: the per-cell counts are a partial aggregate with a proven size bound,
    # so a cell holding a third of all rows is never gathered into one task.
    sizes = keyed.groupBy("cell").agg(F.count(F.lit(1)).alias("group_size"))
    return lookup_join(keyed, sizes, ["cell"]).select("l_orderkey", "l_linenumber", "label", "group_size")


@query("sentiment_tree", f"""
SELECT l_orderkey, l_linenumber, round(avg(l_quantity) OVER (PARTITION BY g1, g2, g3, g4, g5), 4) AS prediction
FROM ({SQL_WEATHER_GROUPS})
""")
def q_sentiment_tree(spark, d):
    model, pts = _sentiment_fit(spark, d)
    return model.transform(pts).select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber",
                                       F.round("prediction", 4).alias("prediction"))


@query("sentiment_tree_mse", f"""
WITH g AS (SELECT l_quantity, avg(l_quantity) OVER (PARTITION BY g1, g2, g3, g4, g5) AS m FROM ({SQL_WEATHER_GROUPS}))
SELECT round(sum((m - l_quantity) * (m - l_quantity)) / count(*), 4) AS mse, count(*) AS n FROM g
""")
def q_sentiment_tree_mse(spark, d):
    model, pts = _sentiment_fit(spark, d)
    return mse(model.transform(pts)).select(F.round("mse", 4).alias("mse"), "n")


# ---------------------------------------------------------------------------------------------
# Entry 3: JSON -> SQL
# ---------------------------------------------------------------------------------------------

@query("json_sql", """
SELECT c_name AS name FROM customer WHERE c_nationkey >= 13 AND c_nationkey <= 19
""")
def q_json_sql(spark, d):
    people = table(spark, d, "customer").select(F.to_json(F.struct(F.col("c_name").alias("name"),
                                                                    F.col("c_nationkey").alias("age"))).alias("v"))
    path = scratch_path(spark, "people")
    write_text(people, path, "v")
    register_view(read_json_lines(spark, path), "people")
    return names_in_range(spark, "people", "name", "age", 13, 19)
