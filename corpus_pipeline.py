"""The corpus pipeline: toxicity, near-duplicates, benchmark passages, pseudonyms, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm.stages import STAGES, run_stages

__all__ = ["STAGES", "ORACLE_SQL", "run"]

#: Learned scores, fingerprints and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, each written and read again."""
    return run_stages(spark, sf_dir, STAGES)
