"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import (bm25_search, fill_middle, gbt_rules, html_extraction, language_model, mixing, near_dup, quality_classifier, sentencepiece_bpe, sharding,
                           token_records, url_filter, vector_codes)
from orderlake.llm.common import table

SHARDS = 40


def _fold(modulus: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels, fold=_fold(3) != 1)
    scored = quality_classifier.score(docs, model)
    return scored.select("doc_id", (_fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents")).drop("copies")


def op3_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bm25_search.search(docs, docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "text"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _fold(7) == 2
    scored, vocab = language_model.fit_and_score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
                         F.lit(vocab.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(spark, table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classify(table(spark, sf_dir, "documents"))


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.write_and_read(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_gbt_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return gbt_rules.verdicts(docs, gbt_rules.fit(docs, table(spark, sf_dir, "labels"))).drop("score")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fill_middle.restore(F.col("output"), F.col("form"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_source_mixing, op3_bm25_search, op4_url_filter, op5_sentencepiece, op6_language_model,
                                   op7_virtual_slots, op8_near_duplicates, op9_token_records, op10_gbt_rules,
                                   op11_html_extraction, op12_vector_codes, op13_fill_middle)}

#: DuckDB texts; operators that SQL cannot express are tested against brute force in tests/llm.
ORACLE = {"op2_source_mixing": mixing.PLAN_SQL, "op3_bm25_search": bm25_search.SEARCH_SQL, "op4_url_filter": url_filter.JUDGE_SQL,
          "op8_near_duplicates": near_dup.CLASSES_SQL, "op11_html_extraction": html_extraction.EXTRACT_SQL, "op12_vector_codes": vector_codes.COMPRESS_SQL,
          "op13_fill_middle": fill_middle.TRANSFORM_SQL}
