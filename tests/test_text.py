"""Golden rows for the text expressions, including every D1 edge."""

import itertools
import re

from tweetlake.functions.text import (normalise_tokens, parse_numbers, remove_patterns, split_lines,
                                      split_on_space, strip_brackets, tokenize_whitespace)
from tweetlake.operators.wordcount import word_count, word_count_v2, word_count_v2_observed


def _one(spark, col, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(col).collect()]


def test_split_on_space_java_rules(spark):
    got = _one(spark, split_on_space("v"), ["a b", "a  b", " a", "a  ", "", "   ", "a\tb "])
    assert got == [["a", "b"], ["a", "", "b"], ["", "a"], ["a"], [""], [], ["a\tb"]]


def test_split_lines_all_terminators(spark):
    assert _one(spark, split_lines("v"), ["a\nb\r\nc\rd"]) == [["a", "b", "c", "d"]]


def test_split_lines_equals_the_pattern_form(spark):
    parts = ["", "a", " ", "\n", "\r", "\r\n", "é"]
    texts = ["".join(p) for n in range(4) for p in itertools.product(parts, repeat=n)]
    want = [re.split(r"\r\n|\r|\n", re.sub(r"(\r\n|\r|\n)\Z", "", t)) if t else [] for t in texts]
    assert _one(spark, split_lines("v"), texts) == want
    assert _one(spark, split_lines("v"), ["x", None]) == [["x"], None]


def test_tokenize_whitespace_never_empty(spark):
    got = _one(spark, tokenize_whitespace("v"), ["  a\tb\n c\fd  ", "", " x y"])
    assert got == [["a", "b", "c", "d"], [], [" x", "y"]]


def test_remove_patterns_in_order(spark):
    # File order matters: removing "ab" first leaves "c"; removing "b" first leaves "ac".
    assert _one(spark, remove_patterns("v", ["ab", "b"]), ["abc"]) == ["c"]
    assert _one(spark, remove_patterns("v", ["b", "ab"]), ["abc"]) == ["ac"]


def test_strip_brackets_and_parse_numbers(spark):
    assert _one(spark, strip_brackets("v"), [" [1.0,2.5] "]) == ["1.0,2.5"]
    assert _one(spark, parse_numbers("v"), [" 1 2.5 -3 "]) == [[1.0, 2.5, -3.0]]


def test_normalise_tokens_contract(spark):
    text = "Know Canberra canberra @John_Hanna x2 a famous outrage Outrage http://t.co/Ab1 the"
    got = _one(spark, normalise_tokens("v"), [text])[0]
    assert got[0] == "canberra" and got.count("canberra") == 1
    assert "john_hanna" not in got and "john" not in got  # runs with a digit/underscore vanish
    assert "know" not in got and "the" not in got and "a" not in got  # stop words, single letters
    assert got.count("outrage") == 1 and "http" in got and "famous" in got
    assert got.index("famous") < got.index("outrage") < got.index("http")  # first-appearance order


def test_word_count_counts_empty_words(spark):
    lines = spark.createDataFrame([("a  b",), ("a ",), ("   ",), ("",)], "value string")
    got = {r["word"]: r["count"] for r in word_count(lines).collect()}
    assert got == {"a": 2, "b": 1, "": 2}


def test_word_count_v2_lower_skip_and_counter(spark):
    lines = spark.createDataFrame([("The cat, the HAT.",), ("",)], "value string")
    got = {r["word"]: r["count"] for r in word_count_v2(lines, case_sensitive=False,
                                                         skip_patterns=[r"\,", r"\."]).collect()}
    assert got == {"the": 2, "cat": 1, "hat": 1}
    counts, obs = word_count_v2_observed(lines)
    counts.collect()
    assert obs.get["input_words"] == 4
