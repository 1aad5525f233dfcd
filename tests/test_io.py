"""Sinks and sources: write modes (K1/K8), text renderings (K2-K9) and round trips."""

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tweetlake.operators.indexing import number_lines
from tweetlake.session import scratch_path
from tweetlake.sources.json import infer_json_schema, parse_json_strings, read_json_lines, rejected_json, rejected_json_lines
from tweetlake.sources.libsvm import read_libsvm
from tweetlake.sources.sinks import (dense_vector_text, pair_text, sparse_text, tab_text, write_libsvm,
                                     write_text)
from tweetlake.sources.text import read_text


def test_overwrite_and_fail_if_exists(spark):
    path = scratch_path(spark, "k8")
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    write_text(df, path, overwrite=False)
    with pytest.raises(Exception):
        write_text(df, path, overwrite=False)
    write_text(df.limit(1), path)  # K1 replaces the target
    assert read_text(spark, path).count() == 1


def test_text_renderings(spark):
    schema = StructType([StructField("id", IntegerType()), StructField("v", VectorUDT()),
                         StructField("k", StringType()), StructField("n", IntegerType())])
    df = spark.createDataFrame([(7, Vectors.dense([1.0, 0.5]), "w", 3)], schema)
    r = df.select(pair_text("id", dense_vector_text("v")).alias("a"), pair_text("k", "n").alias("b"),
                  tab_text("k", "n").alias("c"),
                  sparse_text(F.lit(5), F.array(F.lit(1), F.lit(3))).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == ("(7,[1.0,0.5])", "(w,3)", "w\t3", "(5,[1,3],[1.0,1.0])")


def test_libsvm_round_trip(spark):
    pts = spark.createDataFrame([(1.0, Vectors.sparse(4, [0, 3], [2.0, 5.0])), (0.0, Vectors.dense([0.0, 1.0, 0.0, 0.0]))],
                                StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())]))
    path = scratch_path(spark, "libsvm")
    write_libsvm(pts, path)
    back = sorted((r.label, tuple(r.features.toArray())) for r in read_libsvm(spark, path, num_features=4).collect())
    assert back == [(0.0, (0.0, 1.0, 0.0, 0.0)), (1.0, (2.0, 0.0, 0.0, 5.0))]


def test_skip_patterns_keep_file_order(spark):
    from tweetlake.sources.text import read_skip_patterns
    path = scratch_path(spark, "skip")
    spark.createDataFrame([("ab",), ("[0-9]+",), ("b",)], "value string").coalesce(1).write.text(path)
    assert read_skip_patterns(spark, path) == ["ab", "[0-9]+", "b"]


def test_first_token_lookup_rules(spark):
    from tweetlake.operators.matrix import first_token_index
    docs = spark.createDataFrame([(1, ["b", "a"], False), (2, ["zz"], False), (3, [], False), (4, None, True)],
                                 "doc_id int, tokens array<string>, bad boolean")
    dic = spark.createDataFrame([("a", 0), ("b", 1)], "token string, term_id bigint")
    got = {r.doc_id: (r.token, r.term_id) for r in first_token_index(docs, dic, unparseable_col="bad").collect()}
    assert got == {1: ("b", 1), 2: ("zz", None), 3: (None, None), 4: (None, 1)}


BAD_LINES = ['{"id": 1, "v": {"x": 0.5}}', '{"id": 2}', '{"id": "two"}', '{"id": 3', "[1]", "7", "", "  ", '{"id": 4, "v": {"x": "no"}}', '{"id": null, "more": 1}']


def test_json_lines_policy(spark):
    """Good rows, rejected lines, nulls and failure; blank lines are no records; missing fields are null."""
    path, schema = scratch_path(spark, "policy"), "id BIGINT, v STRUCT<x: DOUBLE>"
    spark.createDataFrame([(x,) for x in BAD_LINES], "value string").write.text(path)
    good = read_json_lines(spark, path, schema, on_error="drop")
    assert sorted((r.id or 0, r.v and r.v.x) for r in good.collect()) == [(0, None), (1, 0.5), (2, None)]
    assert sorted(r.value for r in rejected_json_lines(spark, path, schema).collect()) == sorted(BAD_LINES[i] for i in (2, 3, 4, 5, 8))
    every = read_json_lines(spark, path, schema, on_error="null")
    assert every.count() == 8 and every.where("id IS NULL").count() == 6
    with pytest.raises(Exception, match="bad JSON record"):
        read_json_lines(spark, path, schema, on_error="fail").select("v").count()
    assert read_json_lines(spark, path, schema, on_error="drop").where("id > 1").count() == 1
    with pytest.raises(ValueError):
        read_json_lines(spark, path, schema, on_error="skip")


def test_json_strings_are_inferred_as_the_reader_does(spark):
    rows = ['{"a": 1, "b": {"c": 1.5, "d": [1, 2.25]}, "n": null, "_corrupt_record": 3}', '{"a": 12345678901, "e": true}', "oops", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, s string")
    assert infer_json_schema(df.limit(0), "s") == "STRUCT<>"
    got = parse_json_strings(df, "s", keep=["i"], on_error="drop")
    assert dict(got.dtypes) == {"i": "int", "a": "bigint", "b": "struct<c:double,d:array<double>>", "e": "boolean", "n": "string", "_corrupt_record": "bigint"}
    assert [(r.i, r.a, r["_corrupt_record"]) for r in got.orderBy("i").collect()] == [(0, 1, 3), (1, 12345678901, None)]
    assert [r.i for r in rejected_json(df, "s", keep=["i"]).orderBy("i").collect()] == [2, 3]


def test_line_numbers_of_split_files(spark):
    """Files in path order and lines in file order, however the scan is cut into tasks."""
    path = scratch_path(spark, "numbered")
    names = ["b", "a", "c"]
    for i, name in enumerate(names):
        spark.createDataFrame([(f"{name}{k:03d}",) for k in range(40 * i, 40 * i + 40)], "value string").coalesce(1).write.text(f"{path}/{name}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("64", old[0]):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = sorted(tuple(r) for r in number_lines(spark, f"{path}/*").collect())
            assert [i for i, _ in got] == list(range(120)) and [v for _, v in got] == sorted(v for _, v in got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
