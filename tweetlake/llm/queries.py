"""The corpus operators' queries over whole tables, with their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetlake.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` with its SQL equivalent."""
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


@query("op1_toxic_spans")
def op1_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import toxic_crf
    docs = read_table(spark, sf_dir, "documents")
    model = toxic_crf.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxic_crf.score(docs, model)


SQL_LEDGER = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM t)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM g),
c AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
         len(list_filter(ws, lambda x: regexp_matches(x, '\p{Lu}') AND NOT regexp_matches(x, '\p{Ll}')))::BIGINT AS n_shouts
  FROM t LEFT JOIN c USING (doc_id)),
b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_shouts > 50 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
    + CASE WHEN word_chars > 25 * n_words THEN 64 ELSE 0 END)::BIGINT AS fail_bits
  FROM m)
"""


@query("op3_quality_rules", SQL_LEDGER + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM b""")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import quality_rules as q
    led = q.ledger(read_table(spark, sf_dir, "documents"))
    bits = F.col("fail_bits")
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~q.passes(bits, q.POLICIES["v1_base"])).alias("base_failed"),
                      q.passes(bits, q.POLICIES["v2_full"]).alias("kept"), "fail_bits")


@query("op7_quality_net")
def op7_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import quality_net
    docs = read_table(spark, sf_dir, "documents")
    return quality_net.score(docs, quality_net.fit(docs, read_table(spark, sf_dir, "labels")))


@query("op9_minhash_dedup")
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import minhash_dedup
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), width=4, percent=80)


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import packing
    return packing.pack(read_table(spark, sf_dir, "documents"))


@query("op8_uniform_shards")
def op8_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import sharding
    out = sharding.shard(read_table(spark, sf_dir, "documents").select("doc_id", "text"), 40, stored=True)
    raw = F.coalesce("text", F.lit("")).cast("binary")
    return out.select("doc_id", (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op6_url_language_models")
def op6_url_language_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import url_filter
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.fit(pages))


@query("op10_capture_index", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS lowest FROM d),
-- Base 32: two halves of 80 bits, 16 digits of five bits each.
v AS (
  SELECT *, list_transform([1, 21], lambda s: list_reduce(list_transform(range(s, s + 20),
    lambda i: (strpos('0123456789abcdef', substr(h, i, 1)) - 1)::HUGEINT), lambda a, b: a * 16 + b)) AS halves
  FROM f)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((halves[1 + i // 16] >> (5 * (15 - i % 16))::HUGEINT) & 31::HUGEINT)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = lowest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = lowest THEN NULL ELSE lowest END AS refers_to
FROM v""")
def op10_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import warc
    return warc.round_trip(spark, read_table(spark, sf_dir, "pages"))


@query("op2_projection_dedup")
def op2_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import projection_dedup
    return projection_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query("op4_soft_mixing")
def op4_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import mixing
    docs = read_table(spark, sf_dir, "documents")
    return mixing.rates(docs, docs.select("doc_id", F.col("lang").alias("domain")))


SQL_AUDIT_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


@query("op11_source_divergence", rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '{SQL_AUDIT_TERM}') AS ts
  FROM documents),
v AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ts)) AS term FROM d)
  GROUP BY lang, term HAVING count(*) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(ts) AS term FROM d)
  JOIN v USING (lang, term) GROUP BY lang, source, term),
f AS (
  SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n FROM g JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
k AS (SELECT lang, count(*) AS terms FROM v GROUP BY lang),
s AS (
  SELECT f.lang, source, term, n,
         1 + ((n + 2)::HUGEINT * 1000000000) // (sum(n) OVER (PARTITION BY f.lang, source) + 2 * terms) AS p
  FROM f JOIN k USING (lang)),
l AS (
  SELECT lang, term, 1 + ((n + 2)::HUGEINT * 1000000000) // (sum(n) OVER (PARTITION BY lang) + 2 * terms) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM f GROUP BY lang, term) JOIN k USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM s x JOIN s y USING (lang, term)
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
terms AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM s JOIN l USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms)
WHERE rank <= 10""")
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import source_audit
    return source_audit.audit(read_table(spark, sf_dir, "documents"))


SQL_SEARCH_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@query("op12_lexical_scan", rf"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '{SQL_SEARCH_TERM}')) AS term FROM documents),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '{SQL_SEARCH_TERM}')) AS term FROM benchmark),
c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM c GROUP BY doc_id),
a AS (SELECT count(*) AS documents, sum(n)::BIGINT AS length FROM n),
w AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM c, a WHERE term IN (SELECT term FROM i) GROUP BY term, documents),
g AS (
  SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // length))) AS gain
  FROM c JOIN w USING (term) JOIN n USING (doc_id), a),
s AS (SELECT item_id, doc_id, sum(gain)::BIGINT AS score FROM i JOIN g USING (term) GROUP BY item_id, doc_id HAVING sum(gain) > 0),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s)
SELECT * FROM r WHERE rank <= 10""")
def op12_lexical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import lexical_scan
    return lexical_scan.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op13_learned_partitions")
def op13_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tweetlake.llm import learned_partitions
    return learned_partitions.neighbours(read_table(spark, sf_dir, "embeddings"))
