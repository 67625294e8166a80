"""Stages of the corpus pipeline: each applies one operator to what is left.

Every stage takes whole rows through Python, so it first bounds the session's Arrow batches by bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import jaccard_join, pii, suffix_dedup, toxicity as tox
from tidewatch.llm.common import bound_batches, fold, read_table, without_ids
from tidewatch.llm.packing import pack, public_vocabulary

SHINGLE_WORDS, SIMILARITY = 5, (80, 100)
PASSAGE_BYTES = 100


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut, under a model of the labelled rows that are not held out."""
    bound_batches(spark)
    return tox.without_toxic(docs, tox.train(docs, read_table(spark, sf_dir, "labels"), fold() != 1))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group: the one with the smallest id.

    Rows of one doc_id stay or go together; rows without doc_id or words stay."""
    bound_batches(spark)
    groups = jaccard_join.join_groups(docs, SHINGLE_WORDS, *SIMILARITY)
    return without_ids(docs, groups.filter(F.col("doc_id") != F.col("component_id")).select("doc_id"))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 100 bytes or more that an earlier document has."""
    bound_batches(spark)
    return suffix_dedup.cleaned(docs, PASSAGE_BYTES)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by the name of its kind."""
    bound_batches(spark)
    return pii.masked(docs, pii.train(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of 1024 tokens, with their ids."""
    bound_batches(spark)
    return pack(docs, *public_vocabulary()).withColumnRenamed("piece", "ids")
