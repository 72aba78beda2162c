"""Corpus preparation: documents through five stages to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bagyard.llm import stages
from bagyard.llm.frames import scratch_path, table

STAGES = [
    ("toxicity", stages.toxicity),
    ("minhash_near_dedup", stages.minhash_near_dedup),
    ("suffix_array_dedup", stages.suffix_array_dedup),
    ("source_mix", stages.source_mix),
    ("best_fit_packing", stages.best_fit_packing),
]

# Learned scores and encoded tokens have no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
