"""ML invariants that hold exactly: separable data, saturated models, known centres."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tweetlake.functions.numeric import value_at
from tweetlake.operators import topics
from tweetlake.operators.cluster import centres, discretise, fit_kmeans, kmeans_cost, nearest_centre, offset_from_mean
from tweetlake.operators.evaluate import accuracy, mse
from tweetlake.operators.evaluate import test_error as error_rate
from tweetlake.operators.models import (fit_logistic, fit_tree_classifier, fit_tree_regressor, hash_split, holdout,
                                        labelled_points, tree_nodes, tree_text, tree_walk)
from tweetlake.session import held, scratch_path
from tweetlake.sources.sinks import save_model


def test_centres_of_two_dimensions(spark):
    df = spark.createDataFrame([(0,), (2,)], "i int")
    assert [r[0] for r in df.select(value_at([[1.0, 2], (3, 4), [5, 6.5]], "i")).collect()] == [[1.0, 2.0], [5.0, 6.5]]
    assert [r[0] for r in df.select(value_at([1, 2, 3], "i")).collect()] == [1.0, 3.0]


def _grid(spark, n=500):
    return spark.range(0, n).select(F.col("id"), (F.col("id") % 5).cast("double").alias("a"),
                                    ((F.col("id") * 3) % 5 * 10).cast("double").alias("b"))


def test_kmeans_recovers_distinct_values(spark):
    df = _grid(spark)
    cs = sorted(c[0] for c in centres(fit_kmeans(df, ["a"], 5, 20, 11, compress=True)))
    assert cs == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert kmeans_cost(df, ["a"], [[c] for c in cs]).first().cost == 0.0


def test_discretise_centre_and_index(spark):
    df = _grid(spark)
    out = discretise(df, ["a", "b"], k=5, output="centre", compress=True)
    assert out.where((F.col("a_centre") != F.col("a")) | (F.col("b_centre") != F.col("b"))).count() == 0
    idx = discretise(df, ["a"], k=5, output="index", compress=True)
    # The index is a relabelling of the value: one index per value and vice versa.
    pairs = idx.select("a", "a_cluster").distinct()
    assert pairs.count() == 5 and pairs.select("a_cluster").distinct().count() == 5


def test_nearest_centre_ties_to_first(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    got = [r[0] for r in df.select(nearest_centre(["x"], [[0.0], [2.0], [4.0]])).collect()]
    assert got == [0, 1]


def test_nominal_tree_predicts_group_means(spark):
    df = spark.range(0, 2000).select((F.col("id") % 5).alias("g1"), ((F.col("id") / 5).cast("int") % 5).alias("g2"),
                                     (F.col("id") % 97).cast("double").alias("y"))
    pts = labelled_points(df, "y", ["g1", "g2"], nominal_arity={"g1": 5, "g2": 5}, keep=["g1", "g2"])
    model = fit_tree_regressor(pts, max_depth=30)
    pred = model.transform(pts)
    means = df.groupBy("g1", "g2").agg(F.avg("y").alias("m"))
    worst = pred.join(means, ["g1", "g2"]).agg(F.max(F.abs(F.col("prediction") - F.col("m")))).first()[0]
    assert worst < 1e-9
    assert tree_text(model, spark).count() > 1


def test_saturated_logistic_gives_frequencies(spark):
    df = spark.range(0, 600).select((F.col("id") % 2 == 0).cast("double").alias("f0"),
                                    (F.col("id") % 2 == 1).cast("double").alias("f1"),
                                    F.when(F.col("id") % 7 < 2, 0).when(F.col("id") % 7 < 5, 1).otherwise(2).alias("y"))
    pts = labelled_points(df, "y", ["f0", "f1"], keep=["f0"])
    model = fit_logistic(pts, max_iter=500, tol=1e-12)
    probs = model.transform(pts).select("f0", vector_to_array("probability").alias("p")).distinct().collect()
    freq = {r.f0: r.p for r in probs}
    want = df.groupBy("f0").pivot("y", [0, 1, 2]).count().collect()
    for r in want:
        tot = r["0"] + r["1"] + r["2"]
        for c in "012":
            assert abs(freq[r.f0][int(c)] - r[c] / tot) < 1e-4


def test_evaluation_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 3.0), (0.0, 2.0)], "prediction double, label double")
    assert accuracy(df).first().accuracy == 0.5
    assert error_rate(df).first().test_error == 0.5
    r = mse(df).first()
    assert (r.sse, r.mse) == (5.0, 1.25)
    assert mse(df, denominator_rows=10).first().mse == 0.5


def test_hash_split_depends_on_key_only(spark):
    df = spark.range(0, 4000).withColumnRenamed("id", "k")
    a = hash_split(df, ["k"], [0.7, 0.3]).collect()
    b = hash_split(df.repartition(5).orderBy(F.rand(3)), ["k"], [0.7, 0.3]).collect()
    assert sorted(a) == sorted(b)
    share = sum(r.part == 0 for r in a) / len(a)
    assert 0.65 < share < 0.75


def _topic_entries():
    """Three topics of words of their own, and a few words of all."""
    rng = np.random.default_rng(3)
    rows = set()
    for doc in range(60):
        own = range(10 * (doc % 3), 10 * (doc % 3) + 10)
        rows |= {(doc, int(t)) for t in [*rng.choice(own, 6, replace=False), *rng.choice(range(30, 37), 2, replace=False)]}
    return sorted(rows)


def test_topics_equal_em_in_memory(spark):
    """Blocks of a few documents and terms against the same updates on plain arrays."""
    rows, k = _topic_entries(), 3
    d, t = np.array(rows).T
    g = topics._start(d, t, k, 5)
    for _ in range(8):
        g = g / g.sum(1, keepdims=True)
        of_docs, of_terms = np.zeros((60, k)), np.zeros((37, k))
        np.add.at(of_docs, d, g)
        np.add.at(of_terms, t, g)
        g = (of_terms[t] + 0.1) * (of_docs[d] + 50 / k) / (of_terms.sum(0) + 37 * 0.1)
    entries = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_number long, term_id long, value double")
    for sizes in ({}, {"docs_each": 7, "terms_each": 4}):
        model = topics.fit_topics(entries, 37, k=k, max_iter=7, seed=5, **sizes)
        got = {r.term_id: r.weights for r in model.terms.collect()}
        assert all(np.allclose(got[i], of_terms[i]) for i in range(37)) and len(got) == 37
        got = {r.doc_number: r.weights for r in model.docs.collect()}
        assert all(np.allclose(got[i], of_docs[i]) for i in range(60)) and len(got) == 60


def test_topics_are_found_as_well_as_by_spark(spark):
    """Log-likelihood of the entries under the fitted topics, against ``pyspark.ml``'s EM."""
    rows = _topic_entries()
    d, t = np.array(rows).T
    entries = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_number long, term_id long, value double")
    model = topics.fit_topics(entries, 37, k=3, max_iter=40)

    def likelihood(of_terms, of_docs):
        p = (of_docs / of_docs.sum(1, keepdims=True)) @ (of_terms / of_terms.sum(0)).T
        return np.log(p[d, t]).mean()

    ours = likelihood(np.array([r.weights for r in model.terms.orderBy("term_id").collect()]),
                      np.array([r.weights for r in model.docs.orderBy("doc_number").collect()]))
    indices = spark.createDataFrame([(i, [int(b) for a, b in rows if a == i]) for i in range(60)], "doc_number long, indices array<bigint>")
    vectors = topics.row_vectors(indices, 37).orderBy("label")
    theirs = topics.fit_lda(vectors, k=3, max_iter=40)
    shares = np.array([r.topicDistribution.toArray() for r in theirs.transform(vectors).orderBy("label").collect()])
    assert ours > likelihood(theirs.topicsMatrix().toArray(), shares) - 0.05


def test_topic_weights_and_distributions(spark):
    pairs = [(i, t, 1.0) for i in range(40) for t in [0, 3] + ([1, 2] if i % 2 else [])]
    model = topics.fit_topics(spark.createDataFrame(pairs, "doc_number long, term_id long, value double"), 5, k=2, max_iter=10)
    terms = topics.topic_terms(model)
    totals = {r.term_id: r.t for r in terms.groupBy("term_id").agg(F.sum("weight").alias("t")).collect()}
    assert {t: round(w, 6) for t, w in totals.items()} == {0: 40, 1: 20, 2: 20, 3: 40}
    assert {round(r.t, 9) for r in terms.groupBy("topic").agg(F.sum("weight_normalised").alias("t")).collect()} == {1.0}
    docs = spark.createDataFrame([(i, f"d{i}") for i in range(41)], "doc_number long, name string")
    dist = {r.name: r.topicDistribution for r in topics.topic_distributions(model, docs).collect()}
    assert len(dist) == 41 and dist["d40"] == [0.0, 0.0]
    assert all(abs(sum(dist[f"d{i}"]) - 1.0) < 1e-9 for i in range(40))
    parts = sorted((r.topic, r.part, r.text) for r in topics.topic_rows(terms, run=3).collect())
    assert [(t, p) for t, p, _ in parts] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    lines = ["".join(x for t, _, x in parts if t == i) for i in (0, 1)]
    assert lines[0].startswith("Topic 0: ") and len(lines[0].split()) == len(lines[1].split()) == 6


def test_topics_of_no_entries(spark):
    model = topics.fit_topics(spark.createDataFrame([], "doc_number long, term_id long, value double"), 0, k=2, max_iter=2)
    docs = spark.createDataFrame([(0,)], "doc_number long")
    assert model.terms.count() == 0 and topics.topic_distributions(model, docs).first().topicDistribution == [0.0, 0.0]


def test_compressed_fits_equal_full_fits(spark):
    df = spark.range(0, 3000).select((F.col("id") % 4).alias("g1"), (F.col("id") % 3).alias("g2"),
                                     (F.col("id") % 11).cast("double").alias("y"), (F.col("id") % 2).alias("c"))
    pts = labelled_points(df, "y", ["g1", "g2"], nominal_arity={"g1": 4, "g2": 3})
    a = fit_tree_regressor(pts, max_depth=10, compress=True).transform(pts).select("prediction").collect()
    b = fit_tree_regressor(pts, max_depth=10, compress=False).transform(pts).select("prediction").collect()
    assert all(abs(x[0] - y[0]) < 1e-9 for x, y in zip(a, b))
    lp = labelled_points(df, "c", ["g1", "g2"])
    pa = fit_logistic(lp, compress=True, max_iter=300, tol=1e-10).coefficientMatrix.toArray()
    pb = fit_logistic(lp, compress=False, max_iter=300, tol=1e-10).coefficientMatrix.toArray()
    assert abs(pa - pb).max() < 1e-4


@pytest.mark.parametrize("compress", [False, True])
def test_settled_kmeans_is_a_fixed_point_of_all_rows(spark, compress):
    """Merged or not, every centre is the mean of the rows assigned to it, and every row is counted."""
    df = spark.range(0, 3000).select((F.col("id") % 11).cast("double").alias("y"), (F.col("id") % 7).cast("double").alias("z"))
    model = fit_kmeans(df, ["y", "z"], 4, 200, 11, compress=compress, tol=0.0)
    rows = offset_from_mean(df, ["y", "z"], model).collect()
    assert len(rows) == 4 and sum(r.size for r in rows) == 3000 and all(r.distance < 1e-9 for r in rows)


def test_a_held_input_is_released(spark):
    df = spark.range(10).select((F.col("id") * 2).alias("x"))
    with held(df) as cached:
        assert cached.is_cached and cached.count() == 10
    assert not cached.is_cached
    with pytest.raises(ValueError), held(df) as cached:
        raise ValueError
    assert not cached.is_cached
    out = discretise(df.select(F.col("x").cast("double").alias("x")), ["x"], k=2, compress=True)
    assert not out.is_cached and out.count() == 10


def test_holdout_parts_are_apart_and_whole(spark):
    df = spark.createDataFrame([(i, None if i % 3 else "k") for i in range(500)], "a long, b string")
    train, test = holdout(df, ["a", "b"], 0.6)
    assert train.count() + test.count() == 500 and train.intersect(test).count() == 0 and 0.5 < train.count() / 500 < 0.7


def test_classes_without_rows_keep_their_place(spark):
    df = spark.range(0, 300).select((F.col("id") % 2).alias("g"), (F.col("id") % 2).alias("y"))
    pts = labelled_points(df, "y", ["g"], num_classes=4)
    for compress in (False, True):
        assert fit_tree_classifier(pts, compress=compress).numClasses == 4
        assert fit_logistic(pts, compress=compress, max_iter=5).numClasses == 4


def test_saved_tree_walks_like_the_model(spark):
    """Numbers and nominal features, classes and numbers; a node knows its parent, depth and weight."""
    df = spark.range(0, 900).select((F.col("id") % 5).alias("g"), (F.col("id") % 13).cast("double").alias("x"),
                                    (F.col("id") * 7 % 5 + F.col("id") % 13).cast("double").alias("y"), (F.col("id") % 13 % 3).alias("c"))
    for label, fit, depth in (("y", fit_tree_regressor, 6), ("c", fit_tree_classifier, 4)):
        pts = labelled_points(df, label, ["g", "x"], nominal_arity={"g": 5})
        model = fit(pts, max_depth=depth, compress=True)
        path = scratch_path(spark, "tree-test")
        save_model(model, path)
        nodes = tree_nodes(spark, path).cache()
        assert nodes.count() == model.numNodes and nodes.agg(F.max("depth")).first()[0] == model.depth
        assert nodes.where("parent IS NULL").first().weight == 900
        inner = nodes.where("feature IS NOT NULL")
        below = nodes.groupBy(F.col("parent").alias("node")).agg(F.sum("weight").alias("w"))
        assert inner.join(below, "node").where("weight <> w").count() == 0
        both = tree_walk(nodes, model.transform(pts).select("features", F.col("prediction").alias("own")), model.depth)
        assert both.count() == 900 and both.where("own <> prediction").count() == 0


def test_kmeans_finds_every_value_of_a_duplicated_feature(spark):
    # Five values with uneven shares, each repeated thousands of times: the k-means|| start
    # samples distinct values once rows are merged, so no value is left without a centre.
    df = spark.range(0, 15000).select((F.col("id") % 12 + 1).alias("month")) \
        .select((F.col("month") % 5).cast("double").alias("m"))
    assert sorted(c[0] for c in centres(fit_kmeans(df, ["m"], 5, 20, 11, compress=True))) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_kmeans_k50_sizes_cover_every_row(spark, sf_dir):
    import __spark_entry__ as E
    out = E.queries()["kmeans_k50"](spark, sf_dir).collect()
    n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert 0 < len(out) <= 50 and sum(r.size for r in out) == n
