"""A training corpus from raw documents: each stage works on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import decontaminate, mixing, simhash, token_files, toxicity
from feedloom.llm.common import Scratch, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, learned from the labelled ones among them."""
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the mix takes, a row for each time."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places, sizes and check sums of the documents' ids, read back from the token files."""
    return token_files.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("token-ID output", token_ids),
]
#: SQL can express neither the first stages nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``; what is between two stages is written to the shared folder."""
    scratch, docs, before = Scratch(spark), table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return result
        docs = scratch.write(result, f"stage-{i}")
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
