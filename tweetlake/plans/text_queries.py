"""Text, JSON, dictionary, matrix and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetlake.functions.json import has_string_field, json_field
from tweetlake.functions.text import longer_than, split_lines, split_on_space
from tweetlake.operators.dictionary import dictionary_from_counts, dictionary_from_words
from tweetlake.operators.indexing import index_rows, index_tokens
from tweetlake.operators.matrix import (dense_presence_text, doc_token_pairs, first_token_index,
                                        presence_long, sparse_rows)
from tweetlake.operators.sets import bag_union, intersect_distinct
from tweetlake.operators.sql import names_in_range, register_view
from tweetlake.operators.wordcount import (input_words, word_count, word_count_v2, word_count_v2_observed,
                                           words_split_on_space)
from tweetlake.sources.json import extract_fields, parse_json_strings
from tweetlake.sources.text import lines_of
from tweetlake.sources.tables import table
from tweetlake.plans.registry import query

# ---------------------------------------------------------------------------------------------
# Shared derivations
# ---------------------------------------------------------------------------------------------

def doc_lines(spark: SparkSession, d: str, keep=("doc_id",)) -> DataFrame:
    """Each newline-separated piece of ``documents.text`` as one text line."""
    return lines_of(table(spark, d, "documents"), "text", keep=list(keep))


def doc_words(spark: SparkSession, d: str) -> DataFrame:
    return words_split_on_space(doc_lines(spark, d), "line", keep=["doc_id"])


def conversation_words(spark: SparkSession, d: str) -> DataFrame:
    lines = lines_of(table(spark, d, "conversations"), "text", keep=["conv_id"])
    return words_split_on_space(lines, "line")


def doc_pairs_and_index(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Distinct ``(doc_id, token)`` pairs and the dictionary index built from them.  Each
    document is one row, so its duplicate words are dropped inside the row (no shuffle).  Nothing is
    cached: the numbered dictionary is a checkpoint, and the pairs are split again for the join."""
    pairs = doc_token_pairs(doc_token_arrays(spark, d))
    return pairs, index_tokens(dictionary_from_words(pairs, "token"), "token", "term_id")


def doc_token_arrays(spark: SparkSession, d: str) -> DataFrame:
    """``(doc_id, tokens)``: the words of every line of the document, in order."""
    docs = table(spark, d, "documents")
    toks = F.flatten(F.transform(split_lines("text"), lambda line: split_on_space(line)))
    return docs.select("doc_id", toks.alias("tokens"))


# SQL fragments mirroring the derivations above.
SQL_LINES = ("CASE WHEN text = '' THEN []::VARCHAR[] ELSE string_split(CASE WHEN ends_with(text, chr(10)) "
             "THEN left(text, length(text) - 1) ELSE text END, chr(10)) END")
SQL_DOC_LINES = f"SELECT doc_id, unnest({SQL_LINES}) AS line FROM documents"
SQL_SPLIT = "CASE WHEN regexp_full_match({x}, ' +') THEN []::VARCHAR[] ELSE string_split(rtrim({x}, ' '), ' ') END"
SQL_DOC_WORDS = f"SELECT doc_id, unnest({SQL_SPLIT.format(x='line')}) AS word FROM ({SQL_DOC_LINES})"
SQL_CONV_WORDS = (f"SELECT unnest({SQL_SPLIT.format(x='line')}) AS word FROM "
                  f"(SELECT unnest({SQL_LINES}) AS line FROM conversations)")
SQL_DICT_INDEX = (f"SELECT word AS token, CAST(row_number() OVER (ORDER BY word) - 1 AS BIGINT) AS term_id "
                  f"FROM (SELECT DISTINCT word FROM ({SQL_DOC_WORDS}))")


# ---------------------------------------------------------------------------------------------
# Word counts (S1 P2 P3 P4 A1; S8 P16-P18 A2 A3 F5)
# ---------------------------------------------------------------------------------------------

@query("word_count", f"""
SELECT word, count(*) AS "count" FROM ({SQL_DOC_WORDS}) GROUP BY word
""")
def q_word_count(spark, d):
    return word_count(doc_lines(spark, d), "line")


# The skip patterns of the MapReduce query (punctuation, then digit runs).
SKIP_PATTERNS = ["[.,;:!?]", "[0-9]+"]
SQL_CONV_TOKENS = ("SELECT unnest(regexp_extract_all(regexp_replace(regexp_replace(lower(text), "
                   "'[.,;:!?]', '', 'g'), '[0-9]+', '', 'g'), '[^ \\t\\n\\r\\f]+')) AS word FROM conversations")


def _conversation_lines(spark, d):
    return lines_of(table(spark, d, "conversations"), "text")


@query("word_count_skip", f"""
SELECT word, count(*) AS "count" FROM ({SQL_CONV_TOKENS}) GROUP BY word
""")
def q_word_count_skip(spark, d):
    return word_count_v2(_conversation_lines(spark, d), "line", case_sensitive=False,
                         skip_patterns=SKIP_PATTERNS)


@query("input_words", f"""
SELECT CAST(count(*) AS BIGINT) AS input_words FROM ({SQL_CONV_TOKENS})
""")
def q_input_words(spark, d):
    return input_words(q_word_count_skip(spark, d))


@query("input_words_observed", f"""
SELECT CAST(count(*) AS BIGINT) AS input_words FROM ({SQL_CONV_TOKENS})
""")
def q_input_words_observed(spark, d):
    """A3 as the job counter: the total rides along the counting job as an ``Observation``
    (no second pass over the input); the counts themselves go to the sink."""
    counts, obs = word_count_v2_observed(_conversation_lines(spark, d), "line", case_sensitive=False,
                                         skip_patterns=SKIP_PATTERNS)
    counts.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(int(obs.get["input_words"]),)], "input_words bigint")


# ---------------------------------------------------------------------------------------------
# JSON (P1 P6)
# ---------------------------------------------------------------------------------------------

@query("json_field", """
SELECT event_id, props->>'$.k' AS k FROM events
""")
def q_json_field(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", json_field("props", "k").alias("k"))


def event_json_lines(spark, d) -> DataFrame:
    """Events as JSON lines of seven shapes: string id, numeric id, no id, null id, malformed,
    an array and an empty line (the shape is picked from the event id)."""
    ev = table(spark, d, "events")
    eid, et = F.col("event_id").cast("string"), F.col("event_type")
    shape = F.pmod(F.col("event_id"), F.lit(7))
    line = (F.when(shape == 0, F.concat(F.lit('{"id":"'), eid, F.lit('","type":"'), et, F.lit('"}')))
            .when(shape == 1, F.concat(F.lit('{"id":'), eid, F.lit(',"type":"'), et, F.lit('"}')))
            .when(shape == 2, F.concat(F.lit('{"type":"'), et, F.lit('"}')))
            .when(shape == 3, F.lit('{"id":null}'))
            .when(shape == 4, F.concat(F.lit('{bad '), eid))
            .when(shape == 5, F.concat(F.lit('['), eid, F.lit(']')))
            .otherwise(F.lit("")))
    return ev.select("event_id", line.alias("line"))


SQL_EVENT_LINES = """
SELECT event_id, CASE event_id % 7
  WHEN 0 THEN '{"id":"' || event_id || '","type":"' || event_type || '"}'
  WHEN 1 THEN '{"id":' || event_id || ',"type":"' || event_type || '"}'
  WHEN 2 THEN '{"type":"' || event_type || '"}'
  WHEN 3 THEN '{"id":null}'
  WHEN 4 THEN '{bad ' || event_id
  WHEN 5 THEN '[' || event_id || ']'
  ELSE '' END AS line FROM events"""


@query("valid_id_lines", f"""
SELECT event_id, line FROM ({SQL_EVENT_LINES})
WHERE CASE WHEN json_valid(line) AND json_type(line) = 'OBJECT' THEN json_type(line, '$.id') = 'VARCHAR' ELSE false END
""")
def q_valid_id_lines(spark, d):
    lines = event_json_lines(spark, d)
    return lines.where(has_string_field("line", "id"))


@query("json_dictionary", f"""
SELECT DISTINCT unnest({SQL_SPLIT.format(x="json_extract_string(line, '$.type')")}) AS token
FROM ({SQL_EVENT_LINES})
WHERE json_valid(line) AND json_type(line) = 'OBJECT' AND json_extract_string(line, '$.type') IS NOT NULL
""")
def q_json_dictionary(spark, d):
    """A6 over a JSON-lines field with the D2 policy 'drop': malformed lines, arrays, empty
    lines and records without the field are left out, the rest split on one space."""
    fields = extract_fields(event_json_lines(spark, d), "line", ["type"], on_error="drop")
    return fields.select(F.explode(split_on_space("type")).alias("token")).distinct()


# ---------------------------------------------------------------------------------------------
# SQL text, line filter
# ---------------------------------------------------------------------------------------------

@query("sql_range", """
SELECT p_name AS name FROM part WHERE p_size >= 13 AND p_size <= 19
""")
def q_sql_range(spark, d):
    register_view(table(spark, d, "part"), "tl_part")
    return names_in_range(spark, "tl_part", "p_name", "p_size", 13, 19)


@query("line_length_filter", f"""
SELECT doc_id, line FROM ({SQL_DOC_LINES}) WHERE length(line) > 2
""")
def q_line_length_filter(spark, d):
    return doc_lines(spark, d).where(longer_than("line", 2))


# ---------------------------------------------------------------------------------------------
# Dictionaries and indexing
# ---------------------------------------------------------------------------------------------

@query("dictionary", f"""
SELECT DISTINCT word AS token FROM ({SQL_DOC_WORDS})
""")
def q_dictionary(spark, d):
    return dictionary_from_words(doc_words(spark, d), "word")


@query("dictionary_keys", f"""
SELECT word AS token FROM ({SQL_DOC_WORDS}) GROUP BY word
""")
def q_dictionary_keys(spark, d):
    return dictionary_from_counts(word_count(doc_lines(spark, d), "line"), "word")


@query("dictionary_index", SQL_DICT_INDEX)
def q_dictionary_index(spark, d):
    return index_tokens(q_dictionary(spark, d), "token", "term_id")


@query("doc_index", """
SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS doc_index, doc_id
FROM documents WHERE length(text) > 2
""")
def q_doc_index(spark, d):
    docs = table(spark, d, "documents").where(longer_than("text", 2))
    return index_rows(docs, "doc_id", "doc_index")


# ---------------------------------------------------------------------------------------------
# Matrices and lookups
# ---------------------------------------------------------------------------------------------

@query("presence_coo", f"""
SELECT DISTINCT w.doc_id, t.term_id, 1.0 AS value
FROM ({SQL_DOC_WORDS}) w JOIN ({SQL_DICT_INDEX}) t ON w.word = t.token
""")
def q_presence_coo(spark, d):
    pairs, vocab = doc_pairs_and_index(spark, d)
    return presence_long(pairs, vocab, pairs_distinct=True)


@query("presence_rows", """
WITH dict AS (SELECT event_type AS token, row_number() OVER (ORDER BY event_type) - 1 AS term_id
              FROM (SELECT DISTINCT event_type FROM events)),
     users AS (SELECT DISTINCT user_id FROM events),
     hits AS (SELECT DISTINCT user_id, event_type FROM events)
SELECT u.user_id, string_agg(CASE WHEN h.user_id IS NULL THEN ' 0' ELSE ' 1' END, '' ORDER BY dict.term_id) AS "row"
FROM users u CROSS JOIN dict LEFT JOIN hits h ON h.user_id = u.user_id AND h.event_type = dict.token
GROUP BY u.user_id
""")
def q_presence_rows(spark, d):
    ev = table(spark, d, "events")
    vocab = index_tokens(ev.select(F.col("event_type").alias("token")).distinct())
    size = vocab.count()
    pairs = ev.select(F.col("user_id"), F.col("event_type").alias("token"))
    return dense_presence_text(presence_long(pairs, vocab, doc_col="user_id"), size, doc_col="user_id")


@query("sparse_rows", f"""
WITH t AS ({SQL_DICT_INDEX}),
     p AS (SELECT DISTINCT w.doc_id, t.term_id FROM ({SQL_DOC_WORDS}) w JOIN t ON w.word = t.token),
     n AS (SELECT count(*) AS size FROM t)
SELECT p.doc_id, CAST(n.size AS INTEGER) AS size,
       '(' || n.size || ',[' || string_agg(CAST(p.term_id AS VARCHAR), ',' ORDER BY p.term_id) || '],['
           || string_agg('1.0', ',') || '])' AS vector_text
FROM p CROSS JOIN n GROUP BY p.doc_id, n.size
""")
def q_sparse_rows(spark, d):
    pairs, vocab = doc_pairs_and_index(spark, d)
    size = vocab.count()
    return sparse_rows(presence_long(pairs, vocab, pairs_distinct=True), size).select("doc_id", "size", "vector_text")


@query("first_token_index", f"""
WITH t AS (SELECT word AS token, CAST(row_number() OVER (ORDER BY word) - 1 AS BIGINT) AS term_id
           FROM (SELECT DISTINCT word FROM ({SQL_CONV_WORDS}))),
     f AS (SELECT doc_id, string_split(text, chr(10))[1] AS first_line FROM documents),
     k AS (SELECT doc_id, CASE WHEN regexp_full_match(first_line, ' +') THEN NULL
                               ELSE string_split(rtrim(first_line, ' '), ' ')[1] END AS token FROM f)
SELECT k.doc_id, k.token, t.term_id FROM k LEFT JOIN t ON k.token = t.token
""")
def q_first_token_index(spark, d):
    vocab = index_tokens(dictionary_from_words(conversation_words(spark, d), "word"))
    docs = table(spark, d, "documents")
    first_line = F.element_at(split_lines("text"), 1)
    return first_token_index(docs.select("doc_id", split_on_space(first_line).alias("tokens")), vocab)


@query("first_token_bad_json", f"""
WITH t AS (SELECT word AS token, CAST(row_number() OVER (ORDER BY word) - 1 AS BIGINT) AS term_id
           FROM (SELECT DISTINCT word FROM ({SQL_CONV_WORDS}))),
     f AS (SELECT doc_id, string_split(text, chr(10))[1] AS first_line FROM documents),
     k AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 OR regexp_full_match(first_line, ' +') THEN NULL
                               ELSE string_split(rtrim(first_line, ' '), ' ')[1] END AS token FROM f)
SELECT k.doc_id, k.token, CASE WHEN k.doc_id % 7 = 0 THEN 1 ELSE t.term_id END AS term_id FROM k LEFT JOIN t ON k.token = t.token
""")
def q_first_token_bad_json(spark, d):
    """J4 from JSON rows: a row that does not parse has no token and gets number 1."""
    vocab = index_tokens(dictionary_from_words(conversation_words(spark, d), "word"))
    docs = table(spark, d, "documents").select("doc_id", F.element_at(split_lines("text"), 1).alias("first"))
    line = F.when(F.col("doc_id") % 7 == 0, F.lit('{"first": ')).otherwise(F.to_json(F.struct("first", F.lit(1).alias("whole"))))
    rows = parse_json_strings(docs.select("doc_id", line.alias("line")), "line", "first STRING, whole INT", keep=["doc_id"])
    rows = rows.select("doc_id", split_on_space("first").alias("tokens"), F.col("whole").isNull().alias("bad"))
    return first_token_index(rows, vocab, unparseable_col="bad")


# ---------------------------------------------------------------------------------------------
# Set operations
# ---------------------------------------------------------------------------------------------

@query("lines_intersect", f"""
SELECT word FROM ({SQL_DOC_WORDS}) INTERSECT SELECT word FROM ({SQL_CONV_WORDS})
""")
def q_lines_intersect(spark, d):
    return intersect_distinct(doc_words(spark, d).select("word"), conversation_words(spark, d).select("word"))


@query("bag_union", """
SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey <= 2
UNION ALL
SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey >= 2
""")
def q_bag_union(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return bag_union(nation.where("n_regionkey <= 2"), nation.where("n_regionkey >= 2"))
