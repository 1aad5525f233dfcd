"""Indexing, lookups, sets, SQL and matrices: scalable forms equal their simple definitions."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tweetlake.operators.indexing import index_tokens, number_rows, with_index
from tweetlake.operators.joins import last_row_per_key, lookup_join, strict_lookup
from tweetlake.operators.matrix import dense_presence_text, presence_long, sparse_rows
from tweetlake.operators.sets import bag_union, intersect_distinct
from tweetlake.operators.sql import names_in_range, register_view, schema_table


def test_number_rows_is_dense_and_stays(spark):
    df = spark.range(0, 1000, 1, 7).where("id % 3 > 0").select("id", F.rand().alias("r"))
    numbered = number_rows(df, "ix")
    one, two = ([tuple(x) for x in numbered.orderBy("ix").collect()] for _ in range(2))
    assert one == two and [x[2] for x in one] == list(range(666)) and len({x[0] for x in one}) == 666
    assert number_rows(df.where("id < 0"), "ix").count() == 0


def test_with_index_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    got = with_index(df, [F.col("k")], "ix")
    want = df.select("k", (F.row_number().over(Window.orderBy("k")) - 1).alias("ix"))
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.agg(F.min("ix"), F.max("ix"), F.countDistinct("ix")).first() == (0, 4999, 5000)


def test_index_tokens_binary_order(spark):
    d = spark.createDataFrame([("b",), ("B",), ("a",), ("é",)], "token string")
    got = {r.token: r.term_id for r in index_tokens(d).collect()}
    assert got == {"B": 0, "a": 1, "b": 2, "é": 3}


def test_lookup_join_salted_equals_broadcast(spark):
    # One hot key holds a third of the probe rows.
    probe = spark.range(0, 3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).alias("k"),
                                        F.col("id"))
    lookup = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    a = lookup_join(probe, lookup, ["k"])
    b = lookup_join(probe, lookup, ["k"])
    c = lookup_join(probe, lookup, ["k"], hot_key_share=0.1, salt_buckets=8)
    want = sorted(a.collect())
    assert a.count() == 3000 and want == sorted(b.select(*a.columns).collect())
    assert want == sorted(c.select(*a.columns).collect())
    left = lookup_join(probe, lookup.where("k > 0"), ["k"], "left", hot_key_share=0.1)
    assert left.count() == 3000 and left.where("w is null").count() == probe.where("k = 0").count()


def test_last_row_wins_and_strict_lookup(spark):
    w = spark.createDataFrame([("t1", "x", 1, 10.0), ("t1", "x", 2, 20.0), ("t2", "x", 3, 30.0)],
                              "ts string, loc string, pos int, temp double")
    last = last_row_per_key(w, ["ts", "loc"], "pos")
    assert {(r.ts, r.temp) for r in last.collect()} == {("t1", 20.0), ("t2", 30.0)}
    tweets = spark.createDataFrame([("t1", "x", 1), ("t3", "x", 2)], "ts string, loc string, id int")
    assert strict_lookup(tweets, last, ["ts", "loc"], "temp", on_missing="drop").count() == 1
    assert strict_lookup(tweets, last, ["ts", "loc"], "temp", on_missing="null").where("temp is null").count() == 1
    with pytest.raises(Exception):
        strict_lookup(tweets, last, ["ts", "loc"], "temp").collect()


def test_sets(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "v string")
    b = spark.createDataFrame([("x",), (None,), ("z",)], "v string")
    assert sorted(intersect_distinct(a, b).collect(), key=str) == sorted([("x",), (None,)], key=str)
    assert bag_union(a, b).count() == 7


def test_sql_range_and_schema(spark):
    people = spark.createDataFrame([("a", 12), ("b", 13), ("c", 19), ("d", 20)], "name string, age int")
    register_view(people, "people_t")
    assert sorted(r.name for r in names_in_range(spark, "people_t", "name", "age").collect()) == ["b", "c"]
    st = schema_table(people).orderBy("position").collect()
    assert [(r.field_name, r.data_type) for r in st] == [("name", "string"), ("age", "int")]


def test_presence_sparse_and_dense(spark):
    pairs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "zz"), (2, "c")], "doc_id int, token string")
    dic = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "token string, term_id bigint")
    pres = presence_long(pairs, dic)
    assert sorted((r.doc_id, r.term_id) for r in pres.collect()) == [(1, 0), (1, 1), (2, 2)]
    rows = {r.doc_id: r for r in sparse_rows(pres, 3).collect()}
    assert rows[1][1:] != rows[2][1:]
    dense = {r[0]: r[1] for r in dense_presence_text(pres, 3).collect()}
    assert dense[1].split() == ["1", "1", "0"] and dense[2].split() == ["0", "0", "1"]


def test_failing_checks_survive_pruning(spark):
    import pytest
    from pyspark.errors import PySparkException

    from tweetlake.operators.joins import strict_lookup
    from tweetlake.sources.json import extract_fields
    probe = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    lookup = spark.createDataFrame([("a", None)], "k string, w int")
    assert strict_lookup(probe.where("id = 1"), lookup, ["k"]).collect()[0]["w"] is None
    lines = spark.createDataFrame([('{"id": 1}',), ("{bad",)], "value string")
    for df in (strict_lookup(probe, lookup, ["k"]), extract_fields(lines, "value", ["id"])):
        for forced in (lambda d: d.count(), lambda d: d.select(F.lit(1)).collect()):
            with pytest.raises(PySparkException):
                forced(df)


def test_lines_and_untrimmed_numbers(spark):
    from tweetlake.functions.text import parse_numbers, split_lines
    df = spark.createDataFrame([("a\nb\n",), ("",), ("a\r\n\nb",), ("\n",)], "t string")
    assert [r[0] for r in df.select(split_lines("t")).collect()] == [["a", "b"], [], ["a", "", "b"], [""]]
    one = spark.createDataFrame([("1 2 ",)], "t string")
    assert one.select(parse_numbers("t", trim=False)).first()[0] == [1.0, 2.0]
