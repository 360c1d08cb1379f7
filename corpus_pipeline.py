"""From raw documents to an encoded training mix, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes every stage's
rows as Parquet in the shared checkpoint folder and hands the reread table to the next stage, so a
lost executor never costs more than the stage it was working on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderlake.llm import gbt_rules, mixing, near_dup, quality_classifier, sentencepiece_bpe
from orderlake.llm.common import materialise, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword classifier accepts.

    A NULL or empty text is scored by the end feature alone and a long one whole; equal texts share
    their fate; without labels of both classes the score is the smoothed share of label 1.  Rows keep
    all columns, repeated and NULL ids included; an empty table gives an empty one.
    """
    labels = table(spark, sf_dir, "labels")
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, labels))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted trees.

    Texts under 50 words, NULL and empty ones among them, fail the base rules.  Only labels of the
    documents given here count.  Repeated rows are judged alike; an empty table gives an empty one.
    """
    return gbt_rules.keep_good(docs, gbt_rules.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: a row of the smallest id (NULL ids last), ties by the words' hash.

    NULL and empty texts are one group; of repeated rows one stays; an empty table gives an empty one.
    """
    return near_dup.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them.

    A document may be taken several times or not at all; a NULL source is a source and comes last; a text
    without a word adds nothing to a target; the same rows give the same mix; an empty table gives an empty one.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix, one row per copy.

    NULL and empty texts have no ids; texts of any length are encoded whole; an empty table gives an empty one.
    """
    return sentencepiece_bpe.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality_classifier", classify), ("quality_rules", apply_rules),
          ("near_duplicates", drop_near_duplicates), ("source_mixing", mix_sources),
          ("sentencepiece", encode)]

#: SQL cannot express the trained stages; tests/llm checks each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
