"""The registered queries of the text operators: whole tables, production
parameters.  ``TOKENIZERS`` names the folder of the public vocabulary files."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from evalpress.llm import (bpe_codec, conversation_repair, html_extract, lang_id, line_dedup, minhash_dedup, packing, periodic_runs,
                           quality_rules, quality_votes, simhash, suffix_dedup, toxicity)
from evalpress.llm.common import read


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """Place of a vocabulary file: in ``folder``, or of the installed package."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_decode(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_counts(read(spark, sf_dir, "documents"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compare_edited(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(read(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.conversation_repair(read(spark, sf_dir, "conversations"))


def op13_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_votes.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_packing, op3_html_extract, op4_bpe_codec, op5_lang_id, op6_line_dedup,
                                   op7_minhash_dedup, op8_simhash, op9_toxicity, op10_quality_rules, op11_periodic_runs, op12_conversation_repair, op13_quality_votes)}
#: no operator of this list can be stated in SQL that runs on whole tables in
#: bounded time; tests/llm checks each against brute force or the library
ORACLES: dict[str, str] = {}
