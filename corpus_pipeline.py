"""The corpus pipeline: documents to token ids, each stage a table in the shared folder.

Quality rules drop documents; of each group of near copies the least doc_id stays; strings of 50
bytes that an earlier document holds are cut out; sources are mixed to their target weights, with
repeats; what is left is encoded.

Null and empty texts fail the quality rules. Rows without a doc_id have no key: no stage merges or
cuts them as copies of each other, and they are no earlier document than any. Of rows equal in doc_id and text one stays. Very
long texts pass whole. Other columns, of any name, come through all stages but the last, which adds
its own. An empty table passes through all stages. Each stage is a table in the shared folder, deleted when the
next one is written, so a lost executor costs the tasks it ran and not the stages before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import jaccard, mixture, pieces, quality, repeats
from tallyforge.llm.common import cut, release, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.tokenised(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

# Compression ratios and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, former = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
        release(*former)
        former = [docs]
    return docs
