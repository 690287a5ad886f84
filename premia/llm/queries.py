"""Registered queries of this package, each with its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from premia.llm import bpe, licenses, mixing, negatives, ngrams, oracles, passages, pieces, pii, pivots, rules, simhash, toxicity, trie

VOCABULARY = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_simhash(spark, sf):
    return simhash.simhash_components(_docs(spark, sf))


def op2_pii(spark, sf):
    return pii.scan(_docs(spark, sf))


def op3_bpe(spark, sf):
    return bpe.encode(_docs(spark, sf), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, ids=False)


def op4_passages(spark, sf):
    return passages.repeated_passages(_docs(spark, sf))


def op5_rules(spark, sf):
    return rules.judge(_docs(spark, sf))


def op6_pivots(spark, sf):
    return pivots.link_components(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op7_licenses(spark, sf):
    return licenses.scan(_docs(spark, sf))


def op8_backoff(spark, sf):
    return ngrams.backoff_scores(_docs(spark, sf), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op9_mixing(spark, sf):
    return mixing.mix(_docs(spark, sf))


def op10_toxicity(spark, sf):
    return toxicity.toxicity(_docs(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


def op11_negatives(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table.withColumn("label", moved))


def op12_trie(spark, sf):
    return trie.prefix_trie(spark.read.parquet(f"{sf}/conversations.parquet"))


def op13_pieces(spark, sf):
    return pieces.encode(_docs(spark, sf), public_tokenizers.path(PIECES), ids=False)


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_pii, op3_bpe, op4_passages, op5_rules, op6_pivots, op7_licenses, op8_backoff, op9_mixing, op10_toxicity,
    op11_negatives, op12_trie, op13_pieces,
)} | {"pipeline": corpus_pipeline.run}
SQL = oracles.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
