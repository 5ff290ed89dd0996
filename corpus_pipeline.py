"""A training corpus from raw documents: five stages, each written as Parquet for the next.

1. Language ID: texts that no known language is near to are rejected.
2. N-gram Jaccard join: of each group of near-duplicates, the document of the smallest doc_id stays.
3. Benchmark decontamination: documents that hold a test item go.
4. Mixing: documents come as often as their source's target asks for.
5. Sharding: documents are dealt to 16 shards of near equal bytes, equal texts together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from veedor.llm import decontamination, jaccard_join, language_id, mixing, sharding
from veedor.sources.shared import shared_folder


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs)


def deal_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded_rows(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("jaccard_join", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_to_shards),
]

#: The sketch join, the trained model and the draws are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, from the ``documents`` table on."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/corpus-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
