"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document.  The ledger keeps the measurements and one bit per
failed rule; policies are versioned sets of rules (bit masks), so a policy is applied, changed
or ablated on the ledger alone, without reading a text again.  Everything is column
expressions.

Defined results: a null or empty text has no words, measures zero and fails ``few_words``;
repeated rows give repeated ledger rows; an empty table gives an empty ledger; other columns
of the input, also those named like a measurement, do not enter the ledger.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tweetlake.llm.common import words_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts")

#: Rule -> condition of failure over the measurements; the position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 60 * n_lines",
    "shouting": "100 * n_shouts > 50 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
}

#: Policy version -> the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1_base": ("few_words", "repeated_words"),
    "v2_full": tuple(RULES),
}


def mask_of(policy: tuple[str, ...], rules: Mapping[str, str] = RULES) -> int:
    """The bits of a policy's rules."""
    at = {name: i for i, name in enumerate(rules)}
    return sum(1 << at[r] for r in policy)


def _measured(docs: DataFrame, text_col: str) -> DataFrame:
    """``_words`` ... become measurements step by step, so that no array is built twice."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumns({"_text": text, "_words": words_of(F.col(text_col)),
                           "_lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    df = df.withColumns({"n_words": F.size("_words").cast("long"),
                         "n_lines": F.size("_lines").cast("long"),
                         "word_chars": F.length(F.array_join("_words", "")).cast("long"),
                         "n_symbols": F.size(F.regexp_extract_all("_text", F.lit(r"[#*$%&|<>]"), F.lit(0))).cast("long"),
                         "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                         "n_shouts": F.size(F.filter("_words", lambda w: w.rlike(r"\p{Lu}") & ~w.rlike(r"\p{Ll}"))).cast("long")})
    # A window is known by the 64-bit hash of its three words.
    window = F.when(F.col("n_words") >= 3, F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int")),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_windows", window).drop("_text", "_lines")
    # Texts without a repeated window need no sort.
    has = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(has, F.array_sort(F.transform(
        "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    at = lambda k: F.get("_sorted", k)["h"]
    twice = F.filter("_sorted", lambda s, k: F.coalesce(s["h"] == at(k + 1), F.lit(False))
                     | F.coalesce((k > 0) & (s["h"] == at(k - 1)), F.lit(False)))
    df = df.withColumn("_starts", F.transform(twice, lambda s: s["i"]))
    covered = F.concat("_starts", F.transform("_starts", lambda p: p + 1), F.transform("_starts", lambda p: p + 2))
    return df.withColumn("n_repeat_words", F.coalesce(F.when(has, F.size(F.array_distinct(covered))), F.lit(0)).cast("long"))


def ledger(docs: DataFrame, key: str = "doc_id", text_col: str = "text",
           rules: Mapping[str, str] = RULES) -> DataFrame:
    """key, the measurements and ``fail_bits``: one row per input row."""
    df = _measured(docs.select(F.col(key), F.col(text_col).alias("_raw")), "_raw")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return df.select(key, *MEASURES, bits.alias("fail_bits"))


def passes(bits: Column, policy: tuple[str, ...], rules: Mapping[str, str] = RULES) -> Column:
    """Whether no rule of the policy failed."""
    return bits.bitwiseAND(F.lit(mask_of(policy, rules)).cast("long")) == 0


def keep(docs: DataFrame, policy: str = "v2_full", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the policy accepts."""
    packed = docs.select(F.struct("*").alias("_doc"), F.col(text_col).alias("_raw"))
    df = _measured(packed, "_raw")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    # A filter would be pushed below the measurements, and each of them evaluated many times.
    kept = F.explode_outer(F.when(passes(bits, POLICIES[policy]), F.array("_doc"))).alias("_kept")
    return df.select(kept).where("_kept IS NOT NULL").select("_kept.*")


def ablation(led: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES,
             rules: Mapping[str, str] = RULES) -> DataFrame:
    """Per policy and rule: documents failing it, failing it alone, and kept without it.

    The ledger is first counted by bit pattern (at most 2^rules rows); the rest is bitwise
    arithmetic on those counts.
    """
    counts = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    at = {name: i for i, name in enumerate(rules)}
    asked = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"),
                               F.lit(mask_of(names, rules)).cast("long").alias("mask"),
                               F.lit(1 << at[r]).cast("long").alias("bit"))
                      for p, names in policies.items() for r in names])
    df = counts.withColumn("_a", F.explode(asked)).select("fail_bits", "n", "_a.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    def total(cond):
        return F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))
    return df.groupBy("policy", "rule").agg(
        total(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(hit == F.col("bit")).alias("n_failed_alone"),
        total(hit == 0).alias("n_kept"),
        total(hit.bitwiseAND(F.bitwise_not("bit")) == 0).alias("n_kept_without"))
