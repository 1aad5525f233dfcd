"""JSON typing (P6/D5/D23), field extraction and numeric rendering."""

from pyspark.sql import functions as F

from tweetlake.functions.json import has_string_field, json_field
from tweetlake.functions.numeric import feature_row_text, round_half_up, round_half_up_text, value_at


def test_valid_id_is_json_string_only(spark):
    lines = ['{"id":"7","t":"x"}', '{"id":7}', '{"id":null}', '{"t":1}', "{bad json", "[1,2]",
             '{"id":"1"} trailing', "{'id':'1'}"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(has_string_field("v", "id")).collect()]
    assert got == [True, False, False, False, False, False, True, False]


def test_json_field_as_text(spark):
    df = spark.createDataFrame([('{"a":{"b":1},"n":2.5,"s":"x"}',)], "v string")
    r = df.select(json_field("v", "a").alias("a"), json_field("v", "n").alias("n"),
                  json_field("v", "s").alias("s"), json_field("v", "zz").alias("z")).first()
    assert (r.a, r.n, r.s, r.z) == ('{"b":1}', "2.5", "x", None)


def test_rounding_and_rows(spark):
    df = spark.createDataFrame([(0.25, 1.04, 2.0, 3.96, 4.0, 5.55)], "a double, b double, c double, d double, e double, f double")
    r = df.select(round_half_up("a").alias("r"), round_half_up_text("b").alias("t"),
                  feature_row_text(["a", "b", "c", "d", "e"]).alias("row"),
                  value_at([1.5, 2.5, 3.5], F.lit(2)).alias("v")).first()
    assert r.r == 0.3 and r.t == "1.0"
    assert r.row == "1:0.3 2:1.0 3:2.0 4:4.0 5:4.0"
    assert r.v == 3.5


def test_extract_fields_error_policies(spark):
    import pytest
    from tweetlake.sources.json import extract_fields
    rows = [(0, '{"id":"a","t":"x y"}'), (1, '{"id":"b"}'), (2, "{bad"), (3, "[1]"), (4, "")]
    df = spark.createDataFrame(rows, "i int, v string")
    drop = extract_fields(df, "v", ["t"], on_error="drop", keep=["i"]).collect()
    assert [(r.i, r.t) for r in drop] == [(0, "x y")]
    null = {r.i: r.t for r in extract_fields(df, "v", ["t"], on_error="null", keep=["i"]).collect()}
    assert null == {0: "x y", 1: None, 2: None, 3: None, 4: None}
    with pytest.raises(Exception, match="bad JSON record"):
        extract_fields(df, "v", ["t"], keep=["i"]).collect()
    assert extract_fields(df.where("i = 0"), "v", ["id", "t"]).first() == ("a", "x y")
