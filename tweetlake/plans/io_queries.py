"""Source/sink round trips, numeric rendering and keyed lookup queries.

Round trips write below the shared checkpoint folder (a fresh path per run) and read the
written files back, so the returned DataFrame is what the sink produced.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tweetlake.functions.numeric import composite_key, feature_row_text, round_half_up, round_half_up_text
from tweetlake.operators.indexing import number_lines
from tweetlake.operators.joins import last_row_per_key, strict_lookup
from tweetlake.operators.sql import schema_table
from tweetlake.operators.wordcount import word_count, word_count_v2
from tweetlake.functions.numeric import to_double
from tweetlake.functions.text import strip_brackets
from tweetlake.plans.registry import query
from tweetlake.plans.text_queries import SKIP_PATTERNS, SQL_CONV_TOKENS, SQL_DOC_WORDS, doc_lines
from tweetlake.session import scratch_path
from tweetlake.sources.json import parse_json_strings, read_json_lines, rejected_json_lines
from tweetlake.sources.libsvm import read_libsvm
from tweetlake.sources.sinks import dense_vector_text, pair_text, tab_text, write_libsvm, write_text
from tweetlake.sources.tables import table
from tweetlake.sources.text import lines_of, read_numeric_vectors, read_skip_patterns, read_text

# ---------------------------------------------------------------------------------------------
# JSON lines with inference (S3 C2) and JSON strings with nesting
# ---------------------------------------------------------------------------------------------


def _orders_as_json_lines(spark, d) -> str:
    path = scratch_path(spark, "orders-json")
    table(spark, d, "orders").write.mode("overwrite").json(path)
    return path


@query("json_lines_infer", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate, o_orderpriority
FROM orders
""")
def q_json_lines_infer(spark, d):
    return read_json_lines(spark, _orders_as_json_lines(spark, d))


@query("schema_table", """
SELECT * FROM (VALUES (0, 'o_custkey', 'bigint', true), (1, 'o_orderdate', 'string', true),
                      (2, 'o_orderkey', 'bigint', true), (3, 'o_orderpriority', 'string', true),
                      (4, 'o_orderstatus', 'string', true), (5, 'o_totalprice', 'double', true))
       AS t(position, field_name, data_type, nullable)
""")
def q_schema_table(spark, d):
    return schema_table(read_json_lines(spark, _orders_as_json_lines(spark, d)))


@query("json_nested", """
SELECT n.n_name AS name, n.n_name AS city, r.r_name AS state
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_json_nested(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    doc = F.to_json(F.struct(F.col("n_name").alias("name"),
                             F.struct(F.col("n_name").alias("city"), F.col("r_name").alias("state")).alias("address")))
    strings = nation.join(region, nation.n_regionkey == region.r_regionkey).select(doc.alias("value"))
    parsed = parse_json_strings(strings, "value")  # schema inferred by a distributed aggregate
    return parsed.select("name", F.col("address.city").alias("city"), F.col("address.state").alias("state"))


@query("json_nested_numbers", """
SELECT n_nationkey::BIGINT AS key, n_nationkey + 0.5::DOUBLE AS half, n_name AS name FROM nation
""")
def q_json_nested_numbers(spark, d):
    """Whole numbers are inferred as BIGINT and others as DOUBLE, inside objects too."""
    doc = F.to_json(F.struct(F.col("n_nationkey").alias("key"), F.struct((F.col("n_nationkey") + 0.5).cast("double").alias("half"), "n_name").alias("at")))
    parsed = parse_json_strings(table(spark, d, "nation").select(doc.alias("value")), "value")
    return parsed.select("key", F.col("at.half").alias("half"), F.col("at.n_name").alias("name"))


# Fixed value: the fields every good line of the next two queries has.
EVENT_SCHEMA = "id BIGINT, value DOUBLE, tag STRUCT<kind: STRING>"


def _event_lines(spark, d) -> str:
    """Events as JSON lines: of every five, two good (one without a value), one cut short, one whose id is a
    text, and one that is an array."""
    e = table(spark, d, "events")
    whole = F.to_json(F.struct(F.col("event_id").alias("id"), "value", F.struct(F.col("event_type").alias("kind")).alias("tag")))
    short = F.to_json(F.struct(F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("kind")).alias("tag")))
    number = F.col("event_id").cast("string")
    line = (F.when(F.col("event_id") % 5 == 0, whole).when(F.col("event_id") % 5 == 1, F.concat(F.lit('{"id":'), number))
            .when(F.col("event_id") % 5 == 2, F.concat(F.lit('{"id":"x'), number, F.lit('"}')))
            .when(F.col("event_id") % 5 == 3, F.concat(F.lit("["), number, F.lit("]"))).otherwise(short))
    path = scratch_path(spark, "event-lines")
    write_text(e.select(line.alias("line")), path, "line")
    return path


@query("json_policy", """
SELECT 'good' AS status, event_id AS id, CASE WHEN event_id % 5 = 0 THEN value END AS value, event_type AS kind, NULL AS line
FROM events WHERE event_id % 5 IN (0, 4)
UNION ALL
SELECT 'bad', NULL, NULL, NULL, CASE event_id % 5 WHEN 1 THEN '{"id":' || event_id WHEN 2 THEN '{"id":"x' || event_id || '"}' ELSE '[' || event_id || ']' END
FROM events WHERE event_id % 5 IN (1, 2, 3)
""")
def q_json_policy(spark, d):
    """S3 + D2: the good records, and the table of the lines that were left out."""
    path = _event_lines(spark, d)
    good = read_json_lines(spark, path, EVENT_SCHEMA, on_error="drop")
    bad = rejected_json_lines(spark, path, EVENT_SCHEMA)
    none = F.lit(None)
    return good.select(F.lit("good").alias("status"), "id", "value", F.col("tag.kind").alias("kind"), none.cast("string").alias("line")).union(
        bad.select(F.lit("bad"), none.cast("long"), none.cast("double"), none.cast("string"), F.col("value")))


@query("json_policy_null", """
SELECT CASE WHEN event_id % 5 IN (0, 4) THEN event_id END AS id, count(*) AS n FROM events GROUP BY 1
""")
def q_json_policy_null(spark, d):
    """S3 + D2: every line is a record, bad ones are null."""
    rows = read_json_lines(spark, _event_lines(spark, d), EVENT_SCHEMA, on_error="null")
    return rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("line_numbers", """
SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS line_no, CAST(o_orderkey AS VARCHAR) AS value FROM orders
""")
def q_line_numbers(spark, d):
    """Line numbers of a folder of five files, from the scan alone."""
    path = scratch_path(spark, "numbered-lines")
    (table(spark, d, "orders").select("o_orderkey").repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey")
     .select(F.col("o_orderkey").cast("string").alias("value")).write.text(path))
    return number_lines(spark, path)


# ---------------------------------------------------------------------------------------------
# Text sinks read back
# ---------------------------------------------------------------------------------------------

@query("text_roundtrip", """
SELECT n_nationkey || ',' || n_name || ',' || n_regionkey AS value FROM nation
""")
def q_text_roundtrip(spark, d):
    nation = table(spark, d, "nation")
    path = scratch_path(spark, "nation-text")
    write_text(nation, path, F.concat_ws(",", "n_nationkey", "n_name", "n_regionkey"))
    write_text(nation, path, F.concat_ws(",", "n_nationkey", "n_name", "n_regionkey"))  # overwrite (K1)
    return read_text(spark, path)


@query("pair_text", f"""
SELECT '(' || word || ',' || count(*) || ')' AS value FROM ({SQL_DOC_WORDS}) GROUP BY word
""")
def q_pair_text(spark, d):
    counts = word_count(doc_lines(spark, d), "line")
    path = scratch_path(spark, "word-pairs")
    write_text(counts, path, pair_text("word", "count"))
    return read_text(spark, path)


@query("tab_text", f"""
SELECT word || chr(9) || count(*) AS value FROM ({SQL_CONV_TOKENS}) GROUP BY word
""")
def q_tab_text(spark, d):
    skip_path = scratch_path(spark, "skip-patterns")
    spark.createDataFrame([(p,) for p in SKIP_PATTERNS], "value string").coalesce(1).write.text(skip_path)
    patterns = read_skip_patterns(spark, skip_path)
    lines = lines_of(table(spark, d, "conversations"), "text")
    counts = word_count_v2(lines, "line", case_sensitive=False, skip_patterns=patterns)
    path = scratch_path(spark, "wordcount-output")
    write_text(counts, path, tab_text("word", "count"), overwrite=False)  # K8/K9: must not exist
    return read_text(spark, path)


# ---------------------------------------------------------------------------------------------
# libsvm and numeric text
# ---------------------------------------------------------------------------------------------

@query("libsvm_roundtrip", """
SELECT CAST(l_linenumber - 1 AS DOUBLE) AS label, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem
""")
def q_libsvm_roundtrip(spark, d):
    li = table(spark, d, "lineitem")
    pts = li.select((F.col("l_linenumber") - 1).cast("double").alias("label"),
                    array_to_vector(F.array("l_quantity", "l_discount", "l_tax")).alias("features"))
    path = scratch_path(spark, "lineitem-libsvm")
    write_libsvm(pts, path)
    back = read_libsvm(spark, path, num_features=3)
    arr = vector_to_array("features")
    return back.select("label", arr[0].alias("f0"), arr[1].alias("f1"), arr[2].alias("f2"))


@query("vector_text", """
SELECT CAST(l_orderkey AS DOUBLE) AS f0, CAST(l_linenumber AS DOUBLE) AS f1,
       l_quantity AS f2, l_extendedprice AS f3, l_discount AS f4 FROM lineitem
""")
def q_vector_text(spark, d):
    li = table(spark, d, "lineitem")
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]
    # numeric text with a leading space on each line, like the bundled LDA input
    text = F.concat(F.lit(" "), F.concat_ws(" ", *[F.col(c).cast("double").cast("string") for c in cols]))
    path = scratch_path(spark, "numeric-text")
    write_text(li, path, text)
    vecs = read_numeric_vectors(spark, path, trim=True, min_length=2)
    arr = vector_to_array("features")
    return vecs.select(*[arr[i].alias(f"f{i}") for i in range(len(cols))])


# ---------------------------------------------------------------------------------------------
# Rounding and feature rows
# ---------------------------------------------------------------------------------------------

def _quarter_grid(li):
    # values on a quarter grid, where half-way ties are exact in binary (see D6)
    return F.floor((F.col("l_extendedprice") / 1000.0 - 20.0) * 4) / 4


@query("round_half_up", """
SELECT l_orderkey, l_linenumber, floor((l_extendedprice / 1000.0 - 20.0) * 4) / 4 AS v,
       round(floor((l_extendedprice / 1000.0 - 20.0) * 4) / 4, 1) AS rounded,
       printf('%.1f', round(floor((l_extendedprice / 1000.0 - 20.0) * 4) / 4, 1)) AS rounded_text
FROM lineitem
""")
def q_round_half_up(spark, d):
    li = table(spark, d, "lineitem")
    v = _quarter_grid(li)
    return li.select("l_orderkey", "l_linenumber", v.alias("v"), round_half_up(v, 1).alias("rounded"),
                     round_half_up_text(v, 1).alias("rounded_text"))


@query("feature_row_text", """
SELECT l_orderkey, l_linenumber,
       '1:' || printf('%.1f', round(l_quantity, 1)) || ' 2:' || printf('%.1f', round(l_extendedprice, 1))
       || ' 3:' || printf('%.1f', round(l_discount, 1)) || ' 4:' || printf('%.1f', round(l_tax, 1))
       || ' 5:' || printf('%.1f', round(CAST(l_linenumber AS DOUBLE), 1)) AS "row"
FROM lineitem
""")
def q_feature_row_text(spark, d):
    li = table(spark, d, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", F.col("l_linenumber").cast("double")]
    return li.select("l_orderkey", "l_linenumber", feature_row_text(cols, 1).alias("row"))


# ---------------------------------------------------------------------------------------------
# Keyed lookup (P14 J1 P21): "tweets" (events) to "weather" (the last event per day and type)
# ---------------------------------------------------------------------------------------------

@query("keyed_lookup", """
WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events),
     w AS (SELECT day, event_type, event_id AS w_event_id, value AS w_value,
                  row_number() OVER (PARTITION BY day, event_type ORDER BY event_id DESC) AS rn FROM e)
SELECT e.event_id, e.value AS label, w.w_event_id, w.w_value, e.day || e.event_type AS key_text
FROM e JOIN w ON e.day = w.day AND e.event_type = w.event_type AND w.rn = 1
""")
def q_keyed_lookup(spark, d):
    ev = table(spark, d, "events").select("event_id", "event_type", "value",
                                          F.date_format("ts", "yyyy-MM-dd").alias("day"))
    weather = last_row_per_key(ev.select("day", "event_type", F.col("event_id").alias("w_event_id"),
                                         F.col("value").alias("w_value")),
                               ["day", "event_type"], "w_event_id")
    joined = strict_lookup(ev, weather, ["day", "event_type"], check_col="w_event_id", on_missing="fail")
    return joined.select("event_id", F.col("value").alias("label"), "w_event_id", "w_value",
                         composite_key("day", "event_type").alias("key_text"))


# ---------------------------------------------------------------------------------------------
# (id, vector) text round trip (K3 K2 K1 -> S1 P11 P12)
# ---------------------------------------------------------------------------------------------

@query("doc_vector_text", """
SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS f0, l_quantity AS f1, l_discount AS f2, l_tax AS f3
FROM lineitem
""")
def q_doc_vector_text(spark, d):
    from pyspark.ml.feature import VectorAssembler
    li = table(spark, d, "lineitem")
    vecs = VectorAssembler(inputCols=["l_linenumber", "l_quantity", "l_discount", "l_tax"],
                           outputCol="v").transform(li.select("l_orderkey", "l_linenumber", "l_quantity",
                                                              "l_discount", "l_tax"))
    path = scratch_path(spark, "id-vector-text")
    write_text(vecs, path, pair_text("l_orderkey", dense_vector_text("v")))
    back = read_text(spark, path)
    # "(id,[a,b,c,d])" -> id and the bracketed list; brackets stripped, numbers parsed
    body = F.expr("substring(value, 2, length(value) - 2)")
    cut = F.instr(body, ",")
    nums = F.transform(F.split(strip_brackets(F.substring(body, cut + 1, 1 << 30)), ","), lambda x: to_double(x))
    parsed = back.select(F.substring(body, 1, cut - 1).cast("bigint").alias("l_orderkey"), nums.alias("v"))
    return parsed.select("l_orderkey", *[F.col("v")[i].alias(f"f{i}") for i in range(4)])
