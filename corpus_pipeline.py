"""Corpus cleaning as a chain of stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``; all but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import stages
from tidewatch.llm.common import read_table
from tidewatch.session import stage_table

STAGES = [
    ("toxicity", stages.toxicity),
    ("near_duplicates", stages.near_duplicates),
    ("passages", stages.passages),
    ("personal_data", stages.personal_data),
    ("packing", stages.packing),
]

# The stages tokenise, fit models and follow links between documents: no SQL
# twin; tests/llm/test_pipeline.py holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
