"""One registered query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import chat, language, merkle, mixing, ngram_join, quality, spelling, suffix_dedup, token_counts, token_files, topk, toxicity, unigram
from riskloom.llm.oracles import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_files.read_token_files(token_files.write_token_files(
        docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(_table(spark, sf_dir, "documents"), width=3, percent=90).drop("class")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_chat_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat.conversation_calls(_table(spark, sf_dir, "conversations"))
    return chat.link_calls(calls, results, chat.REPLY).withColumnRenamed("conv", "conv_id")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"), window=100).select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(merkle.manifest(_table(spark, sf_dir, "documents"))).withColumnRenamed("key", "doc_id")


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(_table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_token_files, op3_ngram_join, op4_quality_rules, op5_token_counts, op6_top_k, op7_sentence_pieces, op8_chat_calls, op9_suffix_dedup, op10_toxicity, op11_merkle_manifest, op12_spelling_groups, op13_language_id)}
ORACLES = {name: sql for name, sql in SQL.items() if name in QUERIES}
