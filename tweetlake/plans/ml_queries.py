"""Clustering, topic-model, tree, logistic, evaluation and split queries.

Inputs are built from the tables so that SQL can state the exact answer a correct fit must
give (e.g. a tree deep enough to separate every group predicts the group mean).
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tweetlake.functions.numeric import round_half_up_text, value_at
from tweetlake.functions.stopwords import FUNCTION_WORDS, STOP_WORDS
from tweetlake.functions.text import join_tokens, normalise_tokens
from tweetlake.operators.cluster import (assemble, centres, centres_table, discretise, fit_kmeans, kmeans_cost,
                                         nearest_centre, offset_from_mean)
from tweetlake.operators.evaluate import accuracy, mismatches, mse, test_error
from tweetlake.operators.models import (fit_logistic, fit_tree_classifier, fit_tree_regressor,
                                        hash_split, labelled_points, random_split, tree_text)
from tweetlake.operators.dictionary import dictionary_from_tokens
from tweetlake.operators.indexing import index_tokens, number_rows
from tweetlake.operators.matrix import doc_token_pairs, presence_long
from tweetlake.operators.topics import blocks_of, fit_topics, topic_distributions, topic_rows, topic_terms, write_topic_rows
from tweetlake.plans.registry import query
from tweetlake.session import scratch_path
from tweetlake.sources.sinks import array_text, load_model, pair_text, save_model, write_text
from tweetlake.sources.tables import table
from tweetlake.sources.text import read_text

# ---------------------------------------------------------------------------------------------
# K-means with known centres
# ---------------------------------------------------------------------------------------------

# Five 1-D centres on l_quantity.  They are dyadic, so every squared distance and
# their sum are exact in binary, and no integer quantity is equidistant from two of them.
QTY_CENTRES = [[4.25], [13.5], [24.125], [33.75], [46.5]]
SQL_QTY_DISTS = "[" + ", ".join(f"(l_quantity - {c[0]}) * (l_quantity - {c[0]})" for c in QTY_CENTRES) + "]"


@query("kmeans_assign", f"""
SELECT l_orderkey, l_linenumber, CAST(list_position({SQL_QTY_DISTS}, list_min({SQL_QTY_DISTS})) - 1 AS INTEGER) AS cluster
FROM lineitem
""")
def q_kmeans_assign(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", nearest_centre(["l_quantity"], QTY_CENTRES).alias("cluster"))


@query("kmeans_centre_value", f"""
SELECT l_orderkey, l_linenumber,
       printf('%.1f', round([{', '.join(str(c[0]) for c in QTY_CENTRES)}][list_position({SQL_QTY_DISTS}, list_min({SQL_QTY_DISTS}))], 1)) AS centre
FROM lineitem
""")
def q_kmeans_centre_value(spark, d):
    li = table(spark, d, "lineitem")
    idx = nearest_centre(["l_quantity"], QTY_CENTRES)
    return li.select("l_orderkey", "l_linenumber",
                     round_half_up_text(value_at([c[0] for c in QTY_CENTRES], idx), 1).alias("centre"))


@query("kmeans_cost", f"""
SELECT sum(list_min({SQL_QTY_DISTS})) AS cost FROM lineitem
""")
def q_kmeans_cost(spark, d):
    return kmeans_cost(table(spark, d, "lineitem"), ["l_quantity"], QTY_CENTRES)


# ---------------------------------------------------------------------------------------------
# K-means fits
# ---------------------------------------------------------------------------------------------

@query("kmeans_fit", """
SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS center FROM orders
""")
def q_kmeans_fit(spark, d):
    orders = table(spark, d, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"))
    model = fit_kmeans(orders, ["priority"], k=5, max_iter=20, seed=11, compress=True)
    return spark.createDataFrame([(round(c[0], 6),) for c in centres(model)], "center double")


# A k-means fit with the reference example's parameters (k=50, 20 iterations) reaches a local
# optimum that SQL cannot state, so this query has no SQL text.
@query("kmeans_k50")
def q_kmeans_k50(spark, d):
    """M1-M3: fit k=50 on two lineitem readings; one row per centre with the number of rows
    assigned to it (the sizes are a partial aggregate)."""
    pts = table(spark, d, "lineitem").select(F.col("l_quantity").cast("double").alias("qty"),
                                             (F.col("l_discount") * 100).alias("disc"))
    model = fit_kmeans(pts, ["qty", "disc"], k=50, max_iter=20, seed=11)
    # With 50 centres the model's own predict beats a 50-term literal expression.
    sizes = (model.transform(assemble(pts, ["qty", "disc"])).groupBy(F.col("prediction").alias("cluster"))
             .agg(F.count(F.lit(1)).alias("size")))
    return (centres_table(model, spark).join(sizes, "cluster", "left")
            .select("cluster", "center", F.coalesce("size", F.lit(0)).alias("size")))


@query("kmeans_k50_settled", """
SELECT CAST(r.range AS INTEGER) AS cluster, CAST(0.0 AS DOUBLE) AS distance,
       (SELECT count(*) FROM lineitem) AS n_rows FROM range(50) r
""")
def q_kmeans_k50_settled(spark, d):
    """M1-M3: a fit run until it settles is a fixed point over the rows as they are: every centre is the
    mean of the rows assigned to it, and every row is assigned."""
    pts = table(spark, d, "lineitem").select(F.col("l_quantity").cast("double").alias("qty"),
                                             (F.col("l_discount") * 100).alias("disc"))
    model = fit_kmeans(pts, ["qty", "disc"], k=50, max_iter=300, seed=11, compress=True, tol=0.0)
    apart = offset_from_mean(pts, ["qty", "disc"], model)
    return apart.crossJoin(apart.agg(F.sum("size").alias("n_rows"))).select("cluster", F.round("distance", 6).alias("distance"), "n_rows")


# Five 2-D centres on (l_quantity, 100 * l_tax), dyadic as above.
PLANE = [[4.25, 1.5], [13.5, 6.125], [24.125, 0.25], [33.75, 4.5], [46.5, 7.75]]
SQL_PLANE = "[" + ", ".join(f"(q - {a}) * (q - {a}) + (t - {b}) * (t - {b})" for a, b in PLANE) + "]"


@query("kmeans_centre_plane", f"""
SELECT l_orderkey, l_linenumber, [{', '.join(f"'[{a},{b}]'" for a, b in PLANE)}][list_position(ds, list_min(ds))] AS centre
FROM (SELECT *, {SQL_PLANE} AS ds FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, round(l_tax * 100) AS t FROM lineitem))
""")
def q_kmeans_centre_plane(spark, d):
    """P22 for centres of two dimensions: each row's centre as text."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"), F.round(F.col("l_tax") * 100).alias("t"))
    return li.select("l_orderkey", "l_linenumber", array_text(value_at(PLANE, nearest_centre(["q", "t"], PLANE))).alias("centre"))


def _five_valued(li):
    return li.select(
        "l_orderkey", "l_linenumber",
        F.pmod(F.col("l_quantity").cast("int"), F.lit(5)).cast("double").alias("f_qty"),
        F.pmod(F.round(F.col("l_discount") * 100).cast("int"), F.lit(5)).cast("double").alias("f_disc"),
        F.pmod(F.round(F.col("l_tax") * 100).cast("int"), F.lit(5)).cast("double").alias("f_tax"),
        F.pmod(F.col("l_linenumber"), F.lit(5)).cast("double").alias("f_line"),
        F.pmod(F.col("l_partkey"), F.lit(5)).cast("double").alias("f_part"))


FIVE = ["f_qty", "f_disc", "f_tax", "f_line", "f_part"]
SQL_FIVE = """SELECT l_orderkey, l_linenumber,
    CAST(CAST(l_quantity AS INTEGER) % 5 AS DOUBLE) AS f_qty,
    CAST(CAST(round(l_discount * 100) AS INTEGER) % 5 AS DOUBLE) AS f_disc,
    CAST(CAST(round(l_tax * 100) AS INTEGER) % 5 AS DOUBLE) AS f_tax,
    CAST(l_linenumber % 5 AS DOUBLE) AS f_line,
    CAST(l_partkey % 5 AS DOUBLE) AS f_part FROM lineitem"""


@query("kmeans_discretise", f"""
SELECT l_orderkey, l_linenumber,
       '1:' || printf('%.1f', f_qty) || ' 2:' || printf('%.1f', f_disc) || ' 3:' || printf('%.1f', f_tax)
       || ' 4:' || printf('%.1f', f_line) || ' 5:' || printf('%.1f', f_part) AS "row"
FROM ({SQL_FIVE})
""")
def q_kmeans_discretise(spark, d):
    from tweetlake.functions.numeric import feature_row_text
    feats = _five_valued(table(spark, d, "lineitem"))
    out = discretise(feats, FIVE, k=5, max_iter=20, seed=11, output="centre", compress=True)
    return out.select("l_orderkey", "l_linenumber",
                      feature_row_text([c + "_centre" for c in FIVE], 1).alias("row"))


@query("kmeans_discretise_index", f"""
WITH f AS ({SQL_FIVE})
SELECT 'f_qty' AS feature, count(*) AS cluster_size FROM f GROUP BY f_qty
UNION ALL SELECT 'f_disc', count(*) FROM f GROUP BY f_disc
UNION ALL SELECT 'f_tax', count(*) FROM f GROUP BY f_tax
UNION ALL SELECT 'f_line', count(*) FROM f GROUP BY f_line
UNION ALL SELECT 'f_part', count(*) FROM f GROUP BY f_part
""")
def q_kmeans_discretise_index(spark, d):
    feats = _five_valued(table(spark, d, "lineitem"))
    out = discretise(feats, FIVE, k=5, max_iter=20, seed=11, output="index", compress=True)
    # cluster indices are arbitrary labels; compare the grouping they induce
    stacked = out.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c + "_cluster").alias("cluster"))
                                             for c in FIVE])).alias("s")).select("s.*")
    return stacked.groupBy("feature", "cluster").agg(F.count(F.lit(1)).alias("cluster_size")).drop("cluster")


# ---------------------------------------------------------------------------------------------
# Topic model
# ---------------------------------------------------------------------------------------------

def _sql_norm_tokens(stop_words: list[str]) -> str:
    stops = "[" + ", ".join(f"'{w}'" for w in stop_words) + "]"
    return f"""
SELECT doc_id, tok, min(pos) AS pos FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS tok,
         unnest(generate_series(1, len(regexp_extract_all(lower(text), '[a-z0-9_]+')))) AS pos
  FROM documents {{where}})
WHERE regexp_full_match(tok, '[a-z][a-z]+') AND NOT list_contains({stops}, tok)
GROUP BY doc_id, tok"""


SQL_NORM_TOKENS = _sql_norm_tokens(STOP_WORDS)
# Without function words only.
SQL_WHOLE_TOKENS = _sql_norm_tokens(FUNCTION_WORDS)


def _doc_norm_tokens(spark, d, stop_words: list[str]):
    return table(spark, d, "documents").select("doc_id", normalise_tokens("text", stop_words).alias("tokens"))


def _entries(spark, d, stop_words: list[str]):
    """The numbered documents with their tokens, the whole dictionary, its size, and the (doc_number, term_id, value)
    entries.  The tokens travel with the numbers, so the texts are tokenised once."""
    docs = number_rows(_doc_norm_tokens(spark, d, stop_words), "doc_number", columnar=True)
    dictionary = index_tokens(dictionary_from_tokens(docs, "tokens"), "token", "term_id")
    entries = presence_long(doc_token_pairs(docs, "doc_number"), dictionary, "doc_number", pairs_distinct=True)
    return docs, dictionary, dictionary.count(), entries


def _topic_model(spark, d, stop_words: list[str]):
    """The model over the whole dictionary, the dictionary, and the numbered documents."""
    docs, dictionary, size, entries = _entries(spark, d, stop_words)
    return (fit_topics(entries, size, k=3, max_iter=20, seed=11, **blocks_of(docs)), dictionary,
            docs.select("doc_id", "doc_number"))


@query("lda_term_totals", f"""
SELECT tok AS term, CAST(count(*) AS DOUBLE) AS total FROM ({SQL_WHOLE_TOKENS.format(where='')}) GROUP BY tok
""")
def q_lda_term_totals(spark, d):
    model, dictionary, _ = _topic_model(spark, d, FUNCTION_WORDS)
    return topic_terms(model, dictionary).groupBy("term").agg(F.round(F.sum("weight"), 6).alias("total"))


SQL_DOC_SUMS = f"""
SELECT d.doc_id, CASE WHEN count(n.tok) > 0 THEN 1.0 ELSE 0.0 END AS total
FROM documents d LEFT JOIN ({SQL_NORM_TOKENS.format(where='')}) n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("lda_doc_sums", SQL_DOC_SUMS)
def q_lda_doc_sums(spark, d):
    model, _, numbers = _topic_model(spark, d, STOP_WORDS)
    total = F.aggregate("topicDistribution", F.lit(0.0), lambda a, x: a + x)
    return topic_distributions(model, numbers).select("doc_id", F.round(total, 6).alias("total"))


@query("topic_doc_text", SQL_DOC_SUMS)
def q_topic_doc_text(spark, d):
    """M8 + K4: every document's ``(doc,[p,p,p])`` as text files, read back and parsed."""
    model, _, numbers = _topic_model(spark, d, STOP_WORDS)
    path = scratch_path(spark, "topic-distributions")
    write_text(topic_distributions(model, numbers), path, pair_text("doc_id", array_text("topicDistribution")))
    lines = read_text(spark, path)
    shares = F.split(F.regexp_extract("value", r"\[(.*)\]", 1), ",")
    total = F.aggregate(F.transform(shares, lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return lines.select(F.regexp_extract("value", r"^\((-?[0-9]+),", 1).cast("long").alias("doc_id"), F.round(total, 6).alias("total"))


@query("lda_vocab_size", f"SELECT CAST(count(DISTINCT tok) AS BIGINT) AS vocab_size FROM ({SQL_WHOLE_TOKENS.format(where='')})")
def q_lda_vocab_size(spark, d):
    """M9: the size of a model's vocabulary is that of the dictionary it is fitted on."""
    return dictionary_from_tokens(_doc_norm_tokens(spark, d, FUNCTION_WORDS), "tokens").agg(F.count(F.lit(1)).alias("vocab_size"))


@query("topic_rows", f"""
SELECT CAST(row_number() OVER (ORDER BY tok) - 1 AS BIGINT) AS term_id, CAST(count(*) AS DOUBLE) AS total
FROM ({SQL_WHOLE_TOKENS.format(where='')}) GROUP BY tok
""")
def q_topic_rows(spark, d):
    """M7 + U2: ``Topic i: w w ...`` in parts, weights in term order, written as text; read back and parsed,
    a term's weights sum to its document frequency."""
    model, _, _ = _topic_model(spark, d, FUNCTION_WORDS)
    path, run = scratch_path(spark, "topic-rows"), 8192
    write_topic_rows(topic_rows(topic_terms(model), run), path)
    fields = F.split("value", "\t")
    parts = read_text(spark, path).select(fields[1].cast("long").alias("part"), F.trim(F.regexp_replace(fields[2], "^Topic [0-9]+:", "")).alias("text"))
    long = parts.select("part", F.posexplode(F.split("text", " ")).alias("at", "weight"))
    return long.groupBy((F.col("part") * run + F.col("at")).alias("term_id")).agg(F.round(F.sum(F.col("weight").cast("double")), 6).alias("total"))


@query("normalise_tokens", f"""
WITH n AS ({SQL_WHOLE_TOKENS.format(where='')})
SELECT d.doc_id, coalesce(string_agg(n.tok, ' ' ORDER BY n.pos) || ' ', '') AS tokens
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
""")
def q_normalise_tokens(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", join_tokens(normalise_tokens("text", FUNCTION_WORDS)).alias("tokens"))


# ---------------------------------------------------------------------------------------------
# Trees (M10 M11 M12 M13 M14)
# ---------------------------------------------------------------------------------------------

@query("tree_regress", """
SELECT l_orderkey, l_linenumber, round(avg(l_quantity) OVER (PARTITION BY l_partkey % 6), 6) AS prediction FROM lineitem
""")
def q_tree_regress(spark, d):
    # Six groups: a greedy depth-5 tree separates them whatever order it splits in (seven
    # could need depth 6), so every leaf predicts its group mean.
    li = table(spark, d, "lineitem").withColumn("g", F.pmod("l_partkey", F.lit(6)))
    pts = labelled_points(li, "l_quantity", ["g"], keep=["l_orderkey", "l_linenumber"])
    model = fit_tree_regressor(pts, max_depth=5, max_bins=32, compress=True)
    return model.transform(pts).select("l_orderkey", "l_linenumber", F.round("prediction", 6).alias("prediction"))


@query("tree_classify", """
WITH c AS (SELECT l_suppkey % 6 AS g, l_partkey % 5 AS label, count(*) AS n FROM lineitem GROUP BY ALL),
     m AS (SELECT g, label FROM (
             SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, label) AS rn FROM c) WHERE rn = 1)
SELECT li.l_orderkey, li.l_linenumber, CAST(m.label AS DOUBLE) AS prediction
FROM lineitem li JOIN m ON li.l_suppkey % 6 = m.g
""")
def q_tree_classify(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.pmod("l_suppkey", F.lit(6)).alias("g"),
                                            F.pmod("l_partkey", F.lit(5)).alias("cls"))
    pts = labelled_points(li, "cls", ["g"], keep=["l_orderkey", "l_linenumber"])
    model = fit_tree_classifier(pts, max_depth=5, max_bins=32, impurity="gini", compress=True)
    return model.transform(pts).select("l_orderkey", "l_linenumber", "prediction")


SQL_THREE = """SELECT l_orderkey, l_linenumber, l_extendedprice,
    l_partkey % 5 AS g1, l_suppkey % 5 AS g2, l_orderkey % 5 AS g3 FROM lineitem"""


def _three_nominal(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice",
                     F.pmod("l_partkey", F.lit(5)).alias("g1"), F.pmod("l_suppkey", F.lit(5)).alias("g2"),
                     F.pmod("l_orderkey", F.lit(5)).alias("g3"))


@query("tree_regress_categorical", f"""
SELECT l_orderkey, l_linenumber, avg(round(l_extendedprice * 100)) OVER (PARTITION BY g1, g2, g3) AS prediction
FROM ({SQL_THREE})
""")
def q_tree_regress_categorical(spark, d):
    """Prices in whole cents: their sums are exact, whatever the order of the rows."""
    data = _three_nominal(spark, d).withColumn("cents", F.round(F.col("l_extendedprice") * 100))
    pts = labelled_points(data, "cents", ["g1", "g2", "g3"], nominal_arity={"g1": 5, "g2": 5, "g3": 5},
                          keep=["l_orderkey", "l_linenumber"])
    model = fit_tree_regressor(pts, max_depth=30, max_bins=32)
    return model.transform(pts).select("l_orderkey", "l_linenumber", "prediction")


@query("tree_text")
def q_tree_text(spark, d):
    data = _three_nominal(spark, d)
    pts = labelled_points(data, "l_extendedprice", ["g1", "g2", "g3"], nominal_arity={"g1": 5, "g2": 5, "g3": 5})
    return tree_text(fit_tree_regressor(pts, max_depth=5, max_bins=32), spark)


# ---------------------------------------------------------------------------------------------
# Logistic regression
# ---------------------------------------------------------------------------------------------

def _one_hot_lines(spark, d):
    li = table(spark, d, "lineitem")
    onehot = [(F.col("l_linenumber") == i).cast("double").alias(f"line_{i}") for i in range(1, 8)]
    base = li.select("l_orderkey", "l_linenumber", F.pmod("l_partkey", F.lit(10)).cast("double").alias("cls"), *onehot)
    return labelled_points(base, "cls", [f"line_{i}" for i in range(1, 8)], keep=["l_orderkey", "l_linenumber"])


def _fit_saturated_logistic(spark, d):
    return fit_logistic(_one_hot_lines(spark, d), fit_intercept=False, reg_param=0.0, max_iter=300, tol=1e-12, compress=True)


SQL_GROUP_FREQ = """
SELECT l_linenumber, label, round(n / sum(n) OVER (PARTITION BY l_linenumber), 4) AS probability,
       CAST(sum(n) OVER (PARTITION BY l_linenumber) AS BIGINT) AS n_rows FROM (
  SELECT l_linenumber, CAST(l_partkey % 10 AS INTEGER) AS label, count(*) AS n FROM lineitem GROUP BY ALL)"""


@query("logistic_fit", SQL_GROUP_FREQ)
def q_logistic_fit(spark, d):
    """Every row is scored; per line number, the mean probability of each class over its rows."""
    model = _fit_saturated_logistic(spark, d)
    probs = model.transform(_one_hot_lines(spark, d)).select("l_linenumber", vector_to_array("probability").alias("p"))
    return (probs.select("l_linenumber", F.posexplode("p").alias("label", "probability")).groupBy("l_linenumber", "label")
            .agg(F.round(F.avg("probability"), 4).alias("probability"), F.count(F.lit(1)).alias("n_rows")))


@query("model_roundtrip", """
WITH c AS (SELECT l_linenumber, l_partkey % 10 AS label, count(*) AS n FROM lineitem GROUP BY ALL),
m AS (SELECT l_linenumber, label FROM (
  SELECT *, row_number() OVER (PARTITION BY l_linenumber ORDER BY n DESC, label) AS rn FROM c) WHERE rn = 1)
SELECT l_orderkey, l_linenumber, CAST(label AS DOUBLE) AS prediction FROM lineitem JOIN m USING (l_linenumber)
""")
def q_model_roundtrip(spark, d):
    """K10 + K11: saved, loaded, and every row scored by what was loaded."""
    model = _fit_saturated_logistic(spark, d)
    path = scratch_path(spark, "logistic-model")
    save_model(model, path)
    loaded = load_model(LogisticRegressionModel, path)
    return loaded.transform(_one_hot_lines(spark, d)).select("l_orderkey", "l_linenumber", "prediction")


# ---------------------------------------------------------------------------------------------
# Evaluation
# ---------------------------------------------------------------------------------------------

@query("accuracy", """
SELECT avg(CASE WHEN 1 - toxic = quality THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n FROM labels
""")
def q_accuracy(spark, d):
    lab = table(spark, d, "labels").select((1 - F.col("toxic")).alias("prediction"), F.col("quality").alias("label"))
    return accuracy(lab)


@query("test_error", """
SELECT sum(CASE WHEN 1 - toxic <> quality THEN 1 ELSE 0 END) AS n_wrong, count(*) AS n,
       sum(CASE WHEN 1 - toxic <> quality THEN 1 ELSE 0 END) / count(*) AS test_error FROM labels
""")
def q_test_error(spark, d):
    lab = table(spark, d, "labels").select((1 - F.col("toxic")).alias("prediction"), F.col("quality").alias("label"))
    return test_error(lab)


@query("mse", """
SELECT sum((round(l_extendedprice / 1000) - l_quantity) * (round(l_extendedprice / 1000) - l_quantity)) AS sse,
       count(*) AS n,
       sum((round(l_extendedprice / 1000) - l_quantity) * (round(l_extendedprice / 1000) - l_quantity)) / count(*) AS mse
FROM lineitem
""")
def q_mse(spark, d):
    li = table(spark, d, "lineitem").select(F.round(F.col("l_extendedprice") / 1000).alias("prediction"),
                                            F.col("l_quantity").alias("label"))
    return mse(li)


@query("mismatch_pairs", """
SELECT doc_id, '(' || CAST(CAST(1 - toxic AS DOUBLE) AS VARCHAR) || ',' || CAST(CAST(quality AS DOUBLE) AS VARCHAR) || ')' AS pair
FROM labels WHERE 1 - toxic <> quality
""")
def q_mismatch_pairs(spark, d):
    """P8 + K5: the (prediction, label) pairs a rule gets wrong, as ``(p,l)`` text."""
    lab = table(spark, d, "labels").select("doc_id", (1 - F.col("toxic")).cast("double").alias("prediction"),
                                           F.col("quality").cast("double").alias("label"))
    return mismatches(lab).select("doc_id", pair_text("prediction", "label").alias("pair"))


# ---------------------------------------------------------------------------------------------
# Splits (R1 D11)
# ---------------------------------------------------------------------------------------------

@query("random_split_union", """
SELECT l_orderkey, l_linenumber FROM lineitem
""")
def q_random_split_union(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    train, test = random_split(li, [0.7, 0.3], seed=11)
    return train.unionByName(test)


SQL_BUCKET = "CAST('0x' || substr(md5(concat_ws('|', {keys})), 1, 8) AS BIGINT) % 10000"


@query("hash_split", f"""
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN {SQL_BUCKET.format(keys='l_orderkey, l_linenumber')} < 7000 THEN 0 ELSE 1 END AS INTEGER) AS part
FROM lineitem
""")
def q_hash_split(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return hash_split(li, ["l_orderkey", "l_linenumber"], [0.7, 0.3])
