"""From raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm import exact_dedup, near_copies, packing, quality
from tradeloom.llm.common import table
from tradeloom.llm.language_id import recognised
from tradeloom.llm.queries import language_network
from tradeloom.session import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; the others go."""
    return recognised(docs, language_network(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    return quality.good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.kept(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word Jaccard of 0.8 or more) the document with the smallest id."""
    return near_copies.kept(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its place in a bin."""
    return packing.pack(packing.items(docs))


STAGES = [("language_id", language), ("quality", good_quality), ("exact_dedup", exact), ("simhash", near), ("packing", packed)]
#: Trained stages can't be stated in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
