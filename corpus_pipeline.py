"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ludolake.llm import host_rules, mixing, ngram_join, packing, pii
from ludolake.llm.queries import with_package
from ludolake.session import stage


@with_package
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host does."""
    return host_rules.passing(docs)


@with_package
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_one(docs)


@with_package
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, terms that disclose it removed."""
    return pii.sanitised(docs)


@with_package
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes, as documents; what it takes twice is two rows."""
    return mixing.mixed_documents(docs)


@with_package
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packing", packed),
]

#: Similar sets, co-occurrence statistics, drawn blocks and packing plans have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
