"""Physical-plan properties that matter at scale, read from ``explain``."""

import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as E
from tweetlake.operators.joins import lookup_join


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_range_filter_and_pruning_reach_the_scan(spark, sf_dir):
    plan = _plan(E.queries()["sql_range"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(p_size), GreaterThanOrEqual(p_size,13), LessThanOrEqual(p_size,19)]" in plan
    assert "ReadSchema: struct<p_name:string,p_size:int>" in plan


def test_word_count_combines_before_the_shuffle(spark, sf_dir):
    plan = _plan(E.queries()["word_count"](spark, sf_dir), "simple")
    assert "partial_count" in plan
    assert plan.count("Exchange hashpartitioning(word") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan or "ReadSchema: struct<text:string>" in plan


def test_lookup_join_forces_no_broadcast_and_caches_nothing(spark):
    probe = spark.range(0, 1000).select((F.col("id") % 10).alias("k"), "id")
    lookup = spark.range(0, 10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(lookup_join(probe, lookup, ["k"]), "simple")
        assert "BroadcastHashJoin" not in plan and "InMemory" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

