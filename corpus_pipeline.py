"""Corpus preparation in five stages, each one operator of ``tweetlake.llm`` over all rows.

Every stage gets the documents its predecessor kept, written as Parquet and read again, and
all but the last return the columns of ``documents``.  Defined results are those of the
operators: null and empty texts and null ids pass the classifier by their score, the rules drop texts of
fewer than 50 words, rows without doc_id are never near copies, unlike texts under one doc_id are
documents of their own, repeated rows leave one, extra columns travel whatever their names, and an
empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetlake.llm import minhash_dedup, mixing, packing, quality_net, quality_rules
from tweetlake.llm.common import read_table
from tweetlake.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_net.keep(docs, quality_net.fit(docs, read_table(spark, sf_dir, "labels")))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the full policy go."""
    return quality_rules.keep(docs, "v2_full")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash_dedup.keep(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that domain tokens meet their targets."""
    return mixing.mix(docs, docs.select("doc_id", F.col("lang").alias("domain")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of at most 4,096 tokens."""
    return packing.pack(docs)


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", rules), ("minhash_near_dedup", near_dedup),
          ("mixing_to_targets", mix), ("best_fit_packing", pack)]

#: The classifier's fitted weights and the packing can't be stated in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
