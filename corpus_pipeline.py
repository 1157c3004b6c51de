"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark leaks, then the mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideglass.llm import decontamination, minhash_dedup, mixing, quality_rules, substring_dedup
from tideglass.llm.common import materialize, table

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("minhash_dedup", minhash_dedup.stage),
    ("substring_dedup", substring_dedup.stage),
    ("decontamination", decontamination.stage),
    ("mixing", mixing.stage),
]

#: SQL has no randomised SVD nor the sentence spans; tests/llm holds the rows against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's output is written as Parquet and read back by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
