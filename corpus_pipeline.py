"""A training-data pipeline over ``documents``: each stage reads what the one
before has written.

language ID (rejected texts go) -> near-duplicates (one document of each group
stays) -> repeated passages (their later copies go) -> benchmark
decontamination (documents with benchmark items go) -> mixing (documents are
taken once or twice, or left, so that sources meet their target weights).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlake.llm.common import small_batches, store, table
from gridlake.llm.langid import keep_identified
from gridlake.llm.minhash import drop_near_duplicates
from gridlake.llm.mixing import mix_documents
from gridlake.llm.spaced import decontaminate
from gridlake.llm.substring import remove_repeats

#: similarity of five-word shingle sets from which documents are duplicates
SIMILAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)        # for the stages that follow as well
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, percent=SIMILAR_PERCENT)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeats),
    ("decontamination", leaks),
    ("mixing", mixing),
]

#: the language classifier has no SQL form; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
