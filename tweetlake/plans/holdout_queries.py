"""Train on one part, score the other: fits judged on rows they have not seen, and trees as tables.

The split follows the rows' keys alone, so SQL draws the same one.  Groups are few and models deep
enough to separate them, so SQL can state what a right fit predicts from the training part: the
group's mean, its most frequent class, or its class frequencies.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import functions as F

from tweetlake.operators.evaluate import accuracy, mse, test_error
from tweetlake.operators.models import (fit_logistic, fit_tree_classifier, fit_tree_regressor, holdout, labelled_points,
                                        tree_nodes, tree_walk)
from tweetlake.plans.ml_queries import SQL_BUCKET
from tweetlake.plans.registry import query
from tweetlake.session import scratch_path
from tweetlake.sources.sinks import load_model, save_model
from tweetlake.sources.tables import table

KEYS = ["l_orderkey", "l_linenumber"]
SQL_PART = SQL_BUCKET.format(keys="l_orderkey, l_linenumber")


def _sql_modes(label: str, group: str, train: int) -> str:
    """CTEs ``p`` (rows with label, group and part), ``m`` (a group's most frequent training class), ``t`` (scored test rows)."""
    return f"""
WITH p AS (SELECT {label} AS label, {group} AS g, {SQL_PART} < {train} AS train FROM lineitem),
c AS (SELECT g, label, count(*) AS n FROM p WHERE train GROUP BY g, label),
m AS (SELECT g, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, label) AS rn FROM c) WHERE rn = 1),
t AS (SELECT p.label, m.prediction FROM p JOIN m USING (g) WHERE NOT p.train)"""


@query("holdout_tree_classify", _sql_modes("l_partkey % 5", "l_suppkey % 6", 7000) + """
SELECT CAST(sum(CASE WHEN label <> prediction THEN 1 ELSE 0 END) AS BIGINT) AS n_wrong, count(*) AS n,
       sum(CASE WHEN label <> prediction THEN 1 ELSE 0 END) / count(*) AS test_error FROM t
""")
def q_holdout_tree_classify(spark, d):
    """M10 + M17 on a 70/30 split: gini, depth 5, 32 bins."""
    li = table(spark, d, "lineitem").select(*KEYS, F.pmod("l_suppkey", F.lit(6)).alias("g"), F.pmod("l_partkey", F.lit(5)).alias("cls"))
    train, test = holdout(labelled_points(li, "cls", ["g"], keep=KEYS, num_classes=5), KEYS, 0.7)
    model = fit_tree_classifier(train, max_depth=5, max_bins=32, impurity="gini", compress=True)
    return test_error(model.transform(test))


@query("holdout_tree_regress", f"""
WITH p AS (SELECT l_quantity AS label, l_partkey % 6 AS g, {SQL_PART} < 7000 AS train FROM lineitem),
m AS (SELECT g, avg(label) AS prediction FROM p WHERE train GROUP BY g),
e AS (SELECT (prediction - label) * (prediction - label) AS se FROM p JOIN m USING (g) WHERE NOT train)
SELECT count(*) AS n_test, (SELECT count(*) FROM lineitem) AS n_all, round(avg(se), 4) AS mse,
       round(sum(se) / (SELECT count(*) FROM lineitem), 4) AS mse_over_all FROM e
""")
def q_holdout_tree_regress(spark, d):
    """M11 + M18 on a 70/30 split, with both denominators of D12: the test rows, and all rows."""
    li = table(spark, d, "lineitem").withColumn("g", F.pmod("l_partkey", F.lit(6)))
    train, test = holdout(labelled_points(li, "l_quantity", ["g"], keep=KEYS), KEYS, 0.7)
    scored = fit_tree_regressor(train, max_depth=5, max_bins=32, compress=True).transform(test)
    n_all = li.count()
    own = mse(scored).select(F.col("n").alias("n_test"), F.round("mse", 4).alias("mse"))
    over_all = mse(scored, denominator_rows=n_all).select(F.lit(n_all).cast("long").alias("n_all"), F.round("mse", 4).alias("mse_over_all"))
    return own.crossJoin(over_all)  # one row each


# Class 0 to 9 whose most frequent value differs by line number.
SQL_TILT = "CAST(floor(l_quantity * l_quantity / (250 + 30 * l_linenumber)) + l_linenumber AS BIGINT) % 10"


@query("holdout_logistic", _sql_modes(SQL_TILT, "l_linenumber", 6000) + """
SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n FROM t
""")
def q_holdout_logistic(spark, d):
    """M15 + M16 on a 60/40 split: ten classes, no intercept, no regularisation."""
    cls = F.pmod((F.floor(F.col("l_quantity") * F.col("l_quantity") / (250 + 30 * F.col("l_linenumber"))) + F.col("l_linenumber")).cast("long"), F.lit(10))
    onehot = [(F.col("l_linenumber") == i).cast("double").alias(f"line_{i}") for i in range(1, 8)]
    li = table(spark, d, "lineitem").select(*KEYS, cls.alias("cls"), *onehot)
    train, test = holdout(labelled_points(li, "cls", [f"line_{i}" for i in range(1, 8)], keep=KEYS, num_classes=10), KEYS, 0.6)
    model = fit_logistic(train, fit_intercept=False, reg_param=0.0, max_iter=100, compress=True)
    return accuracy(model.transform(test))


@query("tree_class_counts", """
WITH c AS (SELECT l_suppkey % 4 AS g, (l_suppkey + CASE WHEN l_partkey % 5 < 2 THEN 1 ELSE 0 END) % 4 AS label, count(*) AS n
           FROM lineitem GROUP BY ALL),
k AS (SELECT range AS label FROM range(6)),
g AS (SELECT g, sum(n) AS n FROM c GROUP BY g)
SELECT CAST(g.g AS DOUBLE) AS g, CAST(k.label AS INTEGER) AS label, round(coalesce(c.n, 0) / g.n, 6) AS probability, CAST(g.n AS BIGINT) AS n_rows
FROM g CROSS JOIN k LEFT JOIN c ON c.g = g.g AND c.label = k.label
""")
def q_tree_class_counts(spark, d):
    """Six classes are announced and the last two have no rows; probabilities still have six places,
    also of a model that was saved and loaded (K10, K11)."""
    other = (F.pmod("l_partkey", F.lit(5)) < 2).cast("int")  # each group's own class leads, so no leaves are merged
    li = table(spark, d, "lineitem").select(F.pmod("l_suppkey", F.lit(4)).alias("g"), F.pmod(F.col("l_suppkey") + other, F.lit(4)).alias("cls"))
    pts = labelled_points(li, "cls", ["g"], num_classes=6)
    path = scratch_path(spark, "class-tree")
    save_model(fit_tree_classifier(pts, max_depth=5, max_bins=32, compress=True), path)
    scored = load_model(DecisionTreeClassificationModel, path).transform(pts)
    place = scored.select(vector_to_array("features")[0].alias("g"), F.posexplode(vector_to_array("probability")).alias("label", "p"))
    return place.groupBy("g", "label").agg(F.round(F.avg("p"), 6).alias("probability"), F.count(F.lit(1)).alias("n_rows"))


SQL_CELLS = """SELECT l_partkey % 5 AS g1, l_suppkey % 5 AS g2, l_quantity FROM lineitem"""


@query("tree_leaves", f"""
SELECT CAST(g1 AS DOUBLE) AS g1, CAST(g2 AS DOUBLE) AS g2, round(avg(l_quantity), 6) AS prediction,
       CAST(count(*) AS DOUBLE) AS weight, count(*) AS n_rows FROM ({SQL_CELLS}) GROUP BY g1, g2
""")
def q_tree_leaves(spark, d):
    """M14 + K10: a tree over two nominal features, saved, read as a table of nodes, and walked by every
    row; of each cell the leaf's prediction and training weight."""
    li = table(spark, d, "lineitem").select(F.pmod("l_partkey", F.lit(5)).alias("g1"), F.pmod("l_suppkey", F.lit(5)).alias("g2"), "l_quantity")
    pts = labelled_points(li, "l_quantity", ["g1", "g2"], nominal_arity={"g1": 5, "g2": 5})
    model = fit_tree_regressor(pts, max_depth=30, max_bins=32, compress=True)
    path = scratch_path(spark, "leaf-tree")
    save_model(model, path)
    depth = load_model(DecisionTreeRegressionModel, path).depth
    walked = tree_walk(tree_nodes(spark, path), pts.select("features"), depth)
    x = vector_to_array("features")
    # Equal in all rows of a leaf.
    return (walked.groupBy(x[0].alias("g1"), x[1].alias("g2"))
            .agg(F.round(F.max("prediction"), 6).alias("prediction"), F.max("weight").alias("weight"), F.count(F.lit(1)).alias("n_rows")))
