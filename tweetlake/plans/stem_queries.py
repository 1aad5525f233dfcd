"""Stemmed normalisation (P20) and its SQL, which states the same published rules as CASE chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from tweetlake.functions import stem as rules
from tweetlake.functions.text import join_tokens, normalise_tokens
from tweetlake.operators.normalise import stemmed_tokens
from tweetlake.plans.ml_queries import SQL_NORM_TOKENS
from tweetlake.plans.registry import query
from tweetlake.sources.tables import table

V = rules.VOWELS
SHORT = rf"regexp_matches({{x}}, '{rules.SHORT_END}')"


def _case(table_: list, region) -> str:
    arms = []
    for suffix, put, after in table_:
        inside = f"length(w) - {len(suffix)} >= {region(suffix)}" + (f" AND regexp_matches(w, '[{after}]{suffix}$')" if after else "")
        arms.append(f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {inside} THEN left(w, length(w) - {len(suffix)}) || '{put}' ELSE w END")
    return "CASE " + " ".join(arms) + " ELSE w END"


def _ed(suffix: str) -> str:
    return f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN regexp_matches(w, '[{V}].*{suffix}$') THEN left(w, length(w) - {len(suffix)}) END"


def sql_stems(words: str) -> str:
    """CTEs that end in ``stems(token, stem)`` for a query of distinct ``token``."""
    starts = " ".join(f"WHEN starts_with(w, '{b}') THEN {len(b)}" for b in rules.BEGINNINGS)
    special = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in rules.SPECIAL.items())
    stay = ", ".join(f"'{x}'" for x in rules.STAY)
    reg = f"length(regexp_extract({{x}}, '^{rules.REGION}'))"
    return f"""
m AS (SELECT token, regexp_replace(regexp_replace(token, '^y', 'Y'), '([{V}])y', '\\1Y', 'g') AS w FROM ({words})),
f AS (SELECT *, CASE {starts} ELSE coalesce(nullif({reg.format(x='w')}, 0), length(w)) END AS r1 FROM m),
g AS (SELECT *, CASE WHEN {reg.format(x='substr(w, r1 + 1)')} = 0 THEN length(w)
                     ELSE r1 + {reg.format(x='substr(w, r1 + 1)')} END AS r2 FROM f),
a AS (SELECT token, r1, r2, CASE WHEN ends_with(w, 'sses') THEN left(w, length(w) - 2)
        WHEN regexp_matches(w, '(ied|ies)$') THEN left(w, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END)
        WHEN regexp_matches(w, '(us|ss)$') THEN w
        WHEN regexp_matches(w, '[{V}].+s$') THEN left(w, length(w) - 1) ELSE w END AS w FROM g),
b AS (SELECT *, w IN ({stay}) AS stays, CASE {_ed('ingly')} {_ed('edly')} {_ed('ing')} {_ed('ed')} END AS bare FROM a),
c AS (SELECT token, r1, r2, stays, CASE
        WHEN ends_with(w, 'eedly') THEN CASE WHEN length(w) - 5 >= r1 THEN left(w, length(w) - 3) ELSE w END
        WHEN ends_with(w, 'eed') THEN CASE WHEN length(w) - 3 >= r1 THEN left(w, length(w) - 1) ELSE w END
        WHEN stays OR bare IS NULL THEN w
        WHEN regexp_matches(bare, '(at|bl|iz)$') THEN bare || 'e'
        WHEN regexp_matches(bare, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(bare, length(bare) - 1)
        WHEN length(bare) <= r1 AND {SHORT.format(x='bare')} THEN bare || 'e' ELSE bare END AS w FROM b),
d AS (SELECT token, r1, r2, stays, CASE WHEN regexp_matches(w, '.[^{V}][yY]$') THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM c),
e AS (SELECT token, r1, r2, stays, {_case(rules.STEP2, lambda s: 'r1')} AS w FROM d),
h AS (SELECT token, r1, r2, stays, {_case(rules.STEP3, lambda s: 'r2' if s == 'ative' else 'r1')} AS w FROM e),
i AS (SELECT token, r1, r2, stays, {_case(rules.STEP4, lambda s: 'r2')} AS w FROM h),
j AS (SELECT token, stays, CASE
        WHEN ends_with(w, 'e') THEN CASE WHEN length(w) - 1 >= r2 OR length(w) - 1 >= r1 AND NOT {SHORT.format(x='left(w, length(w) - 1)')}
                                         THEN left(w, length(w) - 1) ELSE w END
        WHEN ends_with(w, 'll') AND length(w) - 1 >= r2 THEN left(w, length(w) - 1) ELSE w END AS w FROM i),
stems AS (SELECT token, CASE WHEN length(token) <= 2 THEN token ELSE
            CASE token {special} ELSE CASE WHEN stays THEN (SELECT a.w FROM a WHERE a.token = j.token) ELSE replace(w, 'Y', 'y') END END END AS stem FROM j)"""


NORM = SQL_NORM_TOKENS.format(where="")


@query("normalise_tokens_stemmed", f"""
WITH n AS ({NORM}),
{sql_stems('SELECT DISTINCT tok AS token FROM n')},
s AS (SELECT doc_id, stem, min(pos) AS pos FROM n JOIN stems ON token = tok GROUP BY doc_id, stem)
SELECT documents.doc_id, coalesce(string_agg(s.stem, ' ' ORDER BY s.pos) || ' ', '') AS tokens
FROM documents LEFT JOIN s ON s.doc_id = documents.doc_id GROUP BY documents.doc_id
""")
def q_normalise_tokens_stemmed(spark, d):
    return stemmed_tokens(table(spark, d, "documents")).select("doc_id", join_tokens("tokens").alias("tokens"))


@query("stem_vocabulary", f"""
WITH n AS ({NORM}),
{sql_stems('SELECT DISTINCT tok AS token FROM n')}
SELECT token, stem FROM stems
""")
def q_stem_vocabulary(spark, d):
    """Every distinct word of the documents with its stem."""
    words = table(spark, d, "documents").select(F.explode(normalise_tokens("text")).alias("token"))
    return rules.stem_table(words)
