"""Trees, logistic regression, splits.

All fits are ``pyspark.ml`` estimators over a ``(label, features)`` DataFrame.  Nominal
features carry ``ml_attr`` metadata through ``VectorAssembler`` so trees split them as sets.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetlake.session import cut_lineage


def nominal(col: str, arity: int):
    """A 0..arity-1 valued column tagged as nominal (categorical) for tree learners."""
    meta = {"ml_attr": {"type": "nominal", "name": col, "vals": [str(i) for i in range(arity)]}}
    return F.col(col).cast("double").alias(col, metadata=meta)


def _classes(n: int) -> dict:
    return {"ml_attr": {"type": "nominal", "name": "label", "vals": [str(i) for i in range(n)]}}


def labelled_points(df: DataFrame, label: str, features: list[str],
                    nominal_arity: dict[str, int] | None = None, keep: list[str] | None = None,
                    num_classes: int | None = None) -> DataFrame:
    """``(label double, features vector)``; nominal columns carry their arity, and with ``num_classes``
    the label carries its class count, so that classes without rows still have a place in a model."""
    nominal_arity = nominal_arity or {}
    names = [f"_f{i}" for i in range(len(features))]  # kept columns may share a feature's name
    cols = [nominal(c, nominal_arity[c]).alias(n, metadata={"ml_attr": {"type": "nominal", "name": c,
                                                                        "vals": [str(v) for v in range(nominal_arity[c])]}})
            if c in nominal_arity else F.col(c).cast("double").alias(n)
            for c, n in zip(features, names)]
    of_class = {} if num_classes is None else {"metadata": _classes(num_classes)}
    base = df.select(*(keep or []), F.col(label).cast("double").alias("label", **of_class), *cols)
    return VectorAssembler(inputCols=names, outputCol="features").transform(base) \
        .select(*(keep or []), "label", "features")


def compress_points(data: DataFrame, features_col: str = "features", label_col: str = "label",
                    weight_col: str = "_weight") -> DataFrame:
    """Identical ``(features, label)`` rows -> one row with a count weight.

    Impurities, likelihoods and their gradients are sums over rows, so a weighted fit on the
    distinct rows is the fit on all rows.  Grouping is a partial aggregate (a value held by a
    third of all rows is combined inside each task), and every later pass of the iterative fit
    touches the distinct rows only.  Metadata (nominal arities, class counts) is carried over.  Worth
    its shuffle only where values repeat; the merged vectors are dense.
    """
    meta, of_class = data.schema[features_col].metadata, data.schema[label_col].metadata
    grouped = (data.groupBy(vector_to_array(features_col).alias("_f"), F.col(label_col))
               .agg(F.count(F.lit(1)).cast("double").alias(weight_col)))
    return grouped.select(array_to_vector("_f").alias(features_col, metadata=meta),
                          F.col(label_col).alias(label_col, metadata=of_class), weight_col)


def _fit(est, data: DataFrame, compress: bool):
    if compress:
        return est.setWeightCol("_weight").fit(compress_points(data))
    return est.fit(data)


def fit_tree_classifier(data: DataFrame, max_depth: int = 5, max_bins: int = 32,
                        impurity: str = "gini", seed: int = 11, compress: bool = False):
    """M10."""
    return _fit(DecisionTreeClassifier(maxDepth=max_depth, maxBins=max_bins, impurity=impurity, seed=seed),
                data, compress)


def fit_tree_regressor(data: DataFrame, max_depth: int = 5, max_bins: int = 32, seed: int = 11,
                       compress: bool = False):
    """M11/M12 (variance impurity; nominal features from metadata)."""
    return _fit(DecisionTreeRegressor(maxDepth=max_depth, maxBins=max_bins, impurity="variance", seed=seed),
                data, compress)


def fit_logistic(data: DataFrame, fit_intercept: bool = False, reg_param: float = 0.0,
                 max_iter: int = 100, tol: float = 1e-6, compress: bool = False):
    """Multinomial logistic regression by L-BFGS (D14 defaults: no intercept, no
    regularisation); the class count is that of ``labelled_points``, else the labels'."""
    return _fit(LogisticRegression(family="multinomial", fitIntercept=fit_intercept, regParam=reg_param,
                                   maxIter=max_iter, tol=tol), data, compress)


def tree_text(model, spark) -> DataFrame:
    """``toDebugString`` one row per line (the text is the size of the model)."""
    lines = model.toDebugString.splitlines()
    return spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "line_no int, line string")


def tree_nodes(spark, path: str) -> DataFrame:
    """The nodes of a saved tree as a table, read from what ``save_model`` wrote:
    ``(node, parent, side, depth, feature, threshold, categories, prediction, weight)``.

    ``side`` is 'left' or 'right' of the parent.  Rows go left whose value is at most ``threshold``,
    or for a nominal feature one of ``categories``; leaves have none of the three.  ``weight`` is the
    training weight that reached the node.
    """
    raw = spark.read.parquet(f"{path}/data")
    n = raw.select("nodeData.*") if "nodeData" in raw.columns else raw
    inner = F.col("leftChild") >= 0
    by_set = F.col("split.numCategories") >= 0
    limits = F.col("split.leftCategoriesOrThreshold")
    nodes = n.select(F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
                     F.when(inner & ~by_set, F.element_at(limits, 1)).alias("threshold"), F.when(inner & by_set, limits).alias("categories"),
                     "prediction", _node_weight(spark, path).alias("weight"), "leftChild", "rightChild")
    child = lambda c, side: nodes.where(F.col(c) >= 0).select(F.col(c).alias("node"), F.col("node").alias("parent"), F.lit(side).alias("side"))
    tree = nodes.drop("leftChild", "rightChild").join(child("leftChild", "left").union(child("rightChild", "right")), "node", "left")
    # As large as the model; written once, for it is read level by level.
    tree = cut_lineage(tree)
    return cut_lineage(_with_depth(tree).select("node", "parent", "side", "depth", "feature", "threshold", "categories", "prediction", "weight"))


def _node_weight(spark, path: str):
    """Variance keeps (weight, sum, sum of squares) of a node, a classifier a weight per class."""
    of_regression = spark.read.text(f"{path}/metadata").where(F.col("value").contains("DecisionTreeRegression")).limit(1).count() > 0
    stats = F.col("impurityStats")
    return F.element_at(stats, 1) if of_regression else F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)


def _with_depth(tree: DataFrame) -> DataFrame:
    """A tree is at most 30 deep, so its levels are joined one after another until none is left."""
    level = tree.where(F.col("parent").isNull()).withColumn("depth", F.lit(0))
    out, depth = level, 0
    while depth < 30 and not level.isEmpty():
        depth += 1
        level = tree.join(level.select(F.col("node").alias("parent")), "parent").select(*tree.columns).withColumn("depth", F.lit(depth))
        out = out.union(level)
    return out


def tree_walk(nodes: DataFrame, points: DataFrame, depth: int, features_col: str = "features") -> DataFrame:
    """The path join: every row of ``points`` walks down the node table, ``depth`` levels at most, and gets
    its leaf's ``(node, prediction, weight)``; the same as the model's own prediction.  The node table
    has the model's size, which the depth bounds."""
    names = points.columns
    kid = lambda side: F.max(F.when(F.col("side") == side, F.col("node"))).alias(f"_{side}")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("_n")).agg(kid("left"), kid("right"))
    tree = cut_lineage(nodes.select(F.col("node").alias("_n"), "feature", "threshold", "categories").join(kids, "_n"))
    at = points.withColumn("_values", vector_to_array(features_col)).withColumn("_at", F.lit(0))
    for _ in range(depth):
        value = F.element_at("_values", F.col("feature") + 1)
        left = F.coalesce(value <= F.col("threshold"), F.array_contains("categories", value))
        at = (at.join(tree, F.col("_at") == F.col("_n"), "left")
              .select(*names, "_values", F.when(F.col("_n").isNull(), F.col("_at")).when(left, F.col("_left")).otherwise(F.col("_right")).alias("_at")))
    return at.join(nodes.select(F.col("node").alias("_at"), "prediction", "weight"), "_at").select(*names, F.col("_at").alias("node"), "prediction", "weight")


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Spark's seeded random split."""
    return df.randomSplit(weights, seed)


def hash_split(df: DataFrame, key_cols: list[str], weights: list[float], part_col: str = "part") -> DataFrame:
    """A split that depends only on the key (not on partitioning or order): the first eight
    hexadecimal digits of the MD5 of the key's texts joined by ``|``, modulo 10000, against cumulative
    weight cut points; part 0, 1, ...  Any engine with MD5 can draw the same split; a null is the empty text."""
    total = float(sum(weights))
    cuts, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        cuts.append(int(round(acc * 10000)))
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 10000
    part = F.lit(len(weights) - 1)
    for i in reversed(range(len(cuts))):
        part = F.when(bucket < cuts[i], F.lit(i)).otherwise(part)
    return df.withColumn(part_col, part.cast("int"))


def holdout(df: DataFrame, key_cols: list[str], train: float) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` rows of a ``hash_split``; a key is wholly in one of them."""
    parts = hash_split(df, key_cols, [train, 1.0 - train], "_part")
    return parts.where("_part = 0").drop("_part"), parts.where("_part = 1").drop("_part")
