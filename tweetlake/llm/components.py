"""Connected components of an edge table by alternating large-star and small-star steps.

A node's neighbours are only ever reduced with a partial aggregate (their minimum) and joined
back on the node, so a hub with very many neighbours is not gathered in one task.  Each round
is checkpointed in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetlake.llm.common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of an edge; label is the smallest node of its component.

    Self loops and null ends are ignored; repeated edges count once; no edges give no rows.  Labels that
    still change in the last round are an error, never a result.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col("u") > F.col("v")).distinct())
    e = cut(e)
    state = None
    for _ in range(max_rounds):
        # Large star: every node links its larger neighbours to the smallest node beside it.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # Small star: every node links itself and its smaller neighbours to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
            .where(F.col("u") > F.col("v")).distinct())
        e = cut(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
