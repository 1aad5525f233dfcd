"""Sinks and persistence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def write_text(df: DataFrame, path: str, col: str | None = None, overwrite: bool = True) -> None:
    """K1/K8: one line per row.  ``overwrite=False`` fails if the target exists (K8)."""
    out = df.select(_c(col).alias("value")) if col is not None else df
    out.write.mode("overwrite" if overwrite else "errorifexists").text(path)


def double_text(col) -> Column:
    """A double as Java's ``Double.toString`` writes it (Spark's cast uses the same rules)."""
    return _c(col).cast("double").cast("string")


def dense_vector_text(col) -> Column:
    """K2: dense vector as ``[a,b,c]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(vector_to_array(_c(col)), lambda x: x.cast("string")), ","), F.lit("]"))


def array_text(col) -> Column:
    """``[a,b,c]`` for an array of doubles."""
    return F.concat(F.lit("["), F.array_join(F.transform(_c(col), lambda x: x.cast("double").cast("string")), ","), F.lit("]"))


def sparse_text(size, indices, values=None) -> Column:
    """K2: sparse vector as ``(size,[i,...],[v,...])``; values default to 1.0 each."""
    idx = _c(indices)
    vals = F.transform(idx, lambda _: F.lit("1.0")) if values is None else F.transform(_c(values), lambda x: x.cast("double").cast("string"))
    return F.concat(F.lit("("), _c(size).cast("string"), F.lit(",["), F.array_join(idx, ","),
                    F.lit("],["), F.array_join(vals, ","), F.lit("])"))


def pair_text(key, value) -> Column:
    """K3/K4/K5/K7: ``(key,value)``."""
    return F.concat(F.lit("("), _c(key).cast("string"), F.lit(","), _c(value).cast("string"), F.lit(")"))


def tab_text(key, value) -> Column:
    """K9: MapReduce text output, key TAB value."""
    return F.concat_ws("\t", _c(key).cast("string"), _c(value).cast("string"))


def write_libsvm(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """K6: ``(label, features)`` rows as libsvm text."""
    df.select("label", "features").write.mode("overwrite" if overwrite else "errorifexists").format("libsvm").save(path)


def save_model(model, path: str, overwrite: bool = True) -> None:
    """K10."""
    w = model.write()
    if overwrite:
        w = w.overwrite()
    w.save(path)


def load_model(model_cls, path: str):
    """E.g. ``load_model(LogisticRegressionModel, path)``."""
    return model_cls.load(path)
