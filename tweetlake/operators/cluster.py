"""K-means (M1-M4) and the k-means discretiser.

Fits use ``pyspark.ml.clustering.KMeans`` (distributed Lloyd iterations, k-means|| start).
Assignment to known centres is a column expression over the k centres (k x d literals), so it
stays in whole-stage codegen and needs no model object.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tweetlake.functions.numeric import value_at
from tweetlake.session import held


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


def fit_kmeans(df: DataFrame, cols: list[str], k: int, max_iter: int = 20, seed: int = 11,
               init_mode: str = "k-means||", compress: bool = False, tol: float = 1e-4) -> KMeansModel:
    """M1.  The caller persists ``df`` around the fit (K12, ``held``) when it is reused.

    With ``compress`` equal points are first merged into one with a count weight (a partial
    aggregate).  Every Lloyd step is then the same weighted step, over the distinct points instead of
    every row, but the random start is drawn from the merged points, so another local optimum may
    be reached: a feature of a few values finds all of them, other data may end better or worse.
    """
    est = KMeans(k=k, maxIter=max_iter, seed=seed, initMode=init_mode, featuresCol="features", tol=tol)
    if compress:
        points = df.groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
        return est.setWeightCol("_weight").fit(assemble(points, cols))
    return est.fit(assemble(df.select(*cols), cols))


def centres(model: KMeansModel) -> list[list[float]]:
    """M2: cluster centres (k x d; fewer than k when the data has fewer distinct points, D22)."""
    return [[float(x) for x in c] for c in model.clusterCenters()]


def centres_table(model: KMeansModel, spark) -> DataFrame:
    """M2 as a table ``(cluster, center)``."""
    rows = [(i, c) for i, c in enumerate(centres(model))]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def _sq_dists(cols: list[str], cs: list[list[float]]) -> Column:
    per = []
    for c in cs:
        terms = [(F.col(x) - F.lit(float(v))) * (F.col(x) - F.lit(float(v))) for x, v in zip(cols, c)]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        per.append(total)
    return F.array(*per)


def nearest_centre(cols: list[str], cs: list[list[float]]) -> Column:
    """M3: 0-based index of the nearest centre (squared Euclidean; first one on ties)."""
    d = _sq_dists(cols, cs)
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def nearest_sq_distance(cols: list[str], cs: list[list[float]]) -> Column:
    """Squared distance to the nearest centre (one term of M4)."""
    return F.array_min(_sq_dists(cols, cs))


def kmeans_cost(df: DataFrame, cols: list[str], cs: list[list[float]]) -> DataFrame:
    """M4: within-set sum of squared errors of ``df`` for the given centres."""
    return df.agg(F.sum(nearest_sq_distance(cols, cs)).alias("cost"))


def offset_from_mean(df: DataFrame, cols: list[str], model: KMeansModel) -> DataFrame:
    """M1-M3 checked: ``(cluster, size, distance)``, how far each centre lies from the mean of the rows of
    ``df`` assigned to it; 0 everywhere where the fit has settled.  ``df`` is never merged."""
    placed = model.transform(assemble(df, cols)).groupBy(F.col("prediction").alias("cluster")).agg(
        F.count(F.lit(1)).alias("size"), F.array(*[F.avg(c) for c in cols]).alias("_mean"))
    apart = F.aggregate(F.zip_with("center", "_mean", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda x, y: x + y)
    return (centres_table(model, df.sparkSession).join(placed, "cluster", "left")
            .select("cluster", F.coalesce("size", F.lit(0)).alias("size"), F.sqrt(apart).alias("distance")))


def discretise(df: DataFrame, cols: list[str], k: int = 5, max_iter: int = 20, seed: int = 11,
               output: str = "centre", suffix: str | None = None, parallelism: int = 8, compress: bool = False) -> DataFrame:
    """M5a/M5b + J5: one 1-D k-means per column; each row gets, per column, its cluster's
    centre value (``output='centre'``) or cluster index (``'index'``).

    The input is scanned once and cached while the fits run, and released when the last has
    finished.  The fits are independent, so up to ``parallelism`` of them run as concurrent Spark
    jobs (as ``pyspark.ml`` tuning does).  Assignment is a column expression chained on the same
    rows, so values never leave their row (no positional zip).
    """
    suffix = suffix or ("_centre" if output == "centre" else "_cluster")
    with held(df) as cached, ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(cols)))) as pool:
        fitted = list(pool.map(lambda c: centres(fit_kmeans(cached, [c], k, max_iter, seed, compress=compress)), cols))
    out = df
    for c, cs in zip(cols, fitted):
        idx = nearest_centre([c], cs)
        out = out.withColumn(c + suffix, value_at([v[0] for v in cs], idx) if output == "centre" else idx)
    return out
