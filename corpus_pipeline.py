"""From raw documents to token ids: language, near duplicates, repeated passages, mixture, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeloom.llm import stages
from changeloom.sources.workspace import written

STAGES = [
    ("language", stages.language),
    ("near_duplicates", stages.near_duplicates),
    ("repeated_passages", stages.repeated_passages),
    ("mixture", stages.mixture),
    ("pieces", stages.pieces),
]

# Trained models, suffix order and pieces are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each one's rows are stored and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
