"""The queries of the operators, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import (chat_formatting, conversation_repair, html_extraction, lexical_search, mixing, nearest_neighbours,
                           quality_classifier, quality_rules, sentencepiece_bpe, sharding, simhash, token_binary, toxicity)
from tickframe.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_token_binary(spark: SparkSession, root: str) -> DataFrame:
    return token_binary.digests(table(spark, root, "documents"), BYTE_BPE)


def op2_simhash_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, root, "documents"))


def op3_html_extraction(spark: SparkSession, root: str) -> DataFrame:
    return html_extraction.extract(table(spark, root, "pages")).select("page_id", "url", "text", "n_chars")


def op4_nearest_neighbours(spark: SparkSession, root: str) -> DataFrame:
    return nearest_neighbours.search(table(spark, root, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    found = quality_classifier.classify(table(spark, root, "documents"), table(spark, root, "labels"))
    return found.select("doc_id", "evidence", "host_rate", "path_rate", "probability", "kept")


def op6_chat_formatting(spark: SparkSession, root: str) -> DataFrame:
    return chat_formatting.preference_pairs(*chat_formatting.with_other_answers(table(spark, root, "conversations")))


def op7_source_mixing(spark: SparkSession, root: str) -> DataFrame:
    return mixing.document_shares(table(spark, root, "documents"))


def op8_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, root, "documents"), table(spark, root, "labels"))


def op9_sharding(spark: SparkSession, root: str) -> DataFrame:
    return sharding.document_shards(table(spark, root, "documents"))


def op10_sentencepiece(spark: SparkSession, root: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, root, "documents"), PIECE_BPE)


def op11_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.scores(table(spark, root, "documents"), table(spark, root, "labels"))


def op12_conversation_repair(spark: SparkSession, root: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, root, "conversations")).drop("n_rows", "n_repaired")


def op13_lexical_search(spark: SparkSession, root: str) -> DataFrame:
    return lexical_search.search(table(spark, root, "documents"), table(spark, root, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_token_binary, op2_simhash_near_dedup, op3_html_extraction, op4_nearest_neighbours, op5_quality_classifier,
    op6_chat_formatting, op7_source_mixing, op8_quality_rules, op9_sharding, op10_sentencepiece, op11_toxicity,
    op12_conversation_repair, op13_lexical_search)}
SQL = {"op6_chat_formatting": chat_formatting.SQL, "op12_conversation_repair": conversation_repair.SQL,
       "op13_lexical_search": lexical_search.SQL}
