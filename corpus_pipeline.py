"""A training corpus out of raw documents: five stages, each one operator of ``millrace.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.decontamination import clean_documents
from millrace.llm.jaccard_join import Rule, one_of_each
from millrace.llm.mixing import mix_documents
from millrace.llm.quality import keep_good
from millrace.llm.sharding import shard_documents
from millrace.llm.tables import documents, finished, table

#: Near copies share four of five shingles of five words.
NEAR = Rule(size=5, percent=80)
SHARDS = 8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, NEAR)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs, SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", sharding),
]

#: Shingle links, hashes and fitted ratios are beyond SQL; the tests hold the rows against a plain computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages; each stage's rows are written before the next one reads them.

    What a stage wrote on its way is removed with it.
    """
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = finished(spark, lambda docs=docs, stage=stage: stage(spark, docs, sf_dir), name)
    return docs
