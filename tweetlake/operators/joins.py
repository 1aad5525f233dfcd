"""Lookups against a table that is small today but may not stay small.

``lookup_join`` is a plain equi-join: Spark broadcasts the lookup side only below its byte
threshold, else both sides shuffle on the key and AQE's skew-join handling splits a probe key
that holds a great share of the rows.  With ``hot_key_share`` set, hot keys are
also salted explicitly: keys holding at least that share of the probe rows (so at most
``1 / hot_key_share`` of them -- a proven bound, safe to broadcast) spread their probe rows over
``salt_buckets`` tasks, and only their lookup rows are replicated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_SALT_BUCKETS = 64


def lookup_join(probe: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner",
                hot_key_share: float | None = None, salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Equi-join ``probe`` to ``lookup`` (unique on ``on``); nothing is cached or counted first."""
    if how not in ("inner", "left"):
        raise ValueError("lookup_join supports inner and left joins")
    if hot_key_share is None:
        return probe.join(lookup, on, how)
    if not 0.0 < hot_key_share <= 1.0:
        raise ValueError("hot_key_share must be in (0, 1]")
    total = probe.count()
    hot = (probe.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") >= F.lit(total * hot_key_share))
           .select(*on, F.lit(True).alias("_hot")))
    # Probe rows of a hot key pick a bucket by position; every other key stays in bucket 0.
    row_salt = F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(salt_buckets))
    salted_probe = (probe.join(F.broadcast(hot), on, "left")
                    .withColumn("_salt", F.when(F.col("_hot"), row_salt).otherwise(F.lit(0)).cast("int"))
                    .drop("_hot"))
    buckets = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))
    salted_lookup = (lookup.join(F.broadcast(hot), on, "left")
                     .withColumn("_salt", F.explode(buckets)).drop("_hot"))
    return salted_probe.join(salted_lookup, on + ["_salt"], how).drop("_salt")


def last_row_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """J1 de-duplication: the row with the greatest ``order_col`` per key ("last one wins").
    ``max_by`` is a partial aggregate, so a hot key is reduced inside each task first."""
    others = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*others), F.col(order_col)).alias("_last"))
            .select(*keys, "_last.*"))


def strict_lookup(probe: DataFrame, lookup: DataFrame, on: list[str], check_col: str | None = None,
                  on_missing: str = "fail", **kw) -> DataFrame:
    """One output row per probe row.  ``on_missing='fail'`` raises when a key has no
    lookup row (the reference's behaviour); ``'drop'`` keeps only matched rows; ``'null'``
    keeps unmatched rows with NULL lookup columns.

    The check is a filter on a match flag of the lookup side, so it holds whatever columns are
    read later, and a NULL in a lookup column is a value like any other."""
    if on_missing not in ("fail", "drop", "null"):
        raise ValueError("on_missing must be 'fail', 'drop' or 'null'")
    if on_missing == "drop":
        return lookup_join(probe, lookup, on, "inner", **kw)
    joined = lookup_join(probe, lookup.withColumn("_found", F.lit(True)), on, "left", **kw)
    if on_missing == "fail":
        key = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in on])
        missing = F.raise_error(F.concat(F.lit("lookup key missing: "), key)).cast("boolean")
        joined = joined.where(F.when(F.col("_found").isNull(), missing).otherwise(F.lit(True)))
    return joined.drop("_found")
