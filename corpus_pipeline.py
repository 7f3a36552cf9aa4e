"""Corpus pipeline: language ID, line dedup, near-dedup, substring dedup,
packing.  Every stage takes (spark, docs, sf_dir) and works on all rows its
predecessor kept."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evalpress.llm.common import read, staged
from evalpress.llm.lang_id import keep_known
from evalpress.llm.line_dedup import without_repeated_lines
from evalpress.llm.minhash_dedup import keep_one
from evalpress.llm.packing import pack
from evalpress.llm.queries import tokenizer_file
from evalpress.llm.suffix_dedup import without_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return keep_known(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line equals or nearly equals."""
    return without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near duplicates."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without 100-byte strings that also start earlier."""
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 tokens."""
    return pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("substring_dedup", substring_dedup), ("packing", packing)]
#: language scores, sampled-register matches and token ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
