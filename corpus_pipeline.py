"""A training corpus from raw documents: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickframe.llm import mixing, quality_classifier, quality_rules, registry, sentencepiece_bpe, simhash
from tickframe.llm.common import table
from tickframe.session import stage


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    return quality_classifier.kept(docs, table(spark, sf_dir, "labels"))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed limits and the rule trained on the labelled rows of the whole table."""
    return quality_rules.kept(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.representatives(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts of the mix: a document once per copy of its blocks that the mix takes."""
    return mixing.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(docs, registry.PIECE_BPE)


STAGES = [("quality_classifier", quality_classifier_stage), ("quality_rules", quality_rules_stage),
          ("simhash_near_dedup", simhash_near_dedup), ("source_mixing", source_mixing), ("sentencepiece", sentencepiece)]
# SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
