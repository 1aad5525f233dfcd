"""Driver contract: entry runs, keys agree, and fast queries match their SQL at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

FAST = ["word_count", "word_count_skip", "input_words", "json_field", "valid_id_lines", "sql_range",
        "line_length_filter", "dictionary", "dictionary_index", "doc_index", "presence_coo",
        "presence_rows", "sparse_rows", "first_token_index", "lines_intersect", "bag_union",
        "json_nested", "json_sql", "schema_table", "pair_text", "libsvm_roundtrip", "vector_text", "round_half_up",
        "feature_row_text", "keyed_lookup", "kmeans_assign", "kmeans_cost", "normalise_tokens",
        "accuracy", "test_error", "mse", "random_split_union", "json_dictionary", "mismatch_pairs",
        "doc_vector_text", "input_words_observed", "tweet_topics", "sentiment_points", "normalise_tokens_stemmed",
        "stem_vocabulary", "hash_split", "holdout_tree_classify", "holdout_tree_regress", "holdout_logistic", "tree_class_counts",
        "tree_leaves", "kmeans_k50_settled", "kmeans_centre_plane", "topic_rows", "topic_doc_text", "json_policy",
        "json_policy_null", "json_nested_numbers", "line_numbers", "first_token_bad_json", "logistic_fit", "model_roundtrip"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return str(v)


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "count"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", FAST)
def test_query_matches_sql(spark, duck, sf_dir, key):
    sdf = E.queries()[key](spark, sf_dir)
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [c[0] for c in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert _canon([tuple(r) for r in sdf.collect()], sdf.columns) == _canon(cur.fetchall(), ocols)
