"""Corpus pipeline: the stages a document passes on its way into a training mix.

Every stage works on all that its predecessor kept; all but the last return the
columns of ``documents``. Rejections, copies and repeats take effect: what a
stage drops is gone, and a document that the mix takes twice comes twice.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kaiji.llm import langid, mixing, quality, simhash
from kaiji.llm.common import read_table, stage
from kaiji.llm.queries import token_digests


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language stays undetermined go."""
    return langid.keep_identified(docs, "text", "lang", "source")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language's references go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that with the smallest doc_id."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of 150 % of all words at source weights 5, 2, 1, whole documents, repeats as rows."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and the decoded bytes of every document of the mix."""
    return token_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language id", language_id), ("quality rules", quality_rules), ("simhash near-dedup", near_dedup),
          ("mixing sources to target weights", mix_sources), ("byte-level BPE", encode)]

ORACLE_SQL = None  # hashes, trees and learned models have no SQL form; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
