"""The corpus pipeline: documents through the stages in order, each written as Parquet
and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retentia.llm import stages
from retentia.llm.common import table, written

# (name, function of (spark, docs, sf_dir))
STAGES = [
    ("reject_toxic", stages.reject_toxic),
    ("drop_near_copies", stages.drop_near_copies),
    ("redact_pii", stages.redact_pii),
    ("mix_sources", stages.mix_sources),
    ("encode_bytes", stages.encode_bytes),
]

# Model scores, similarity links and merges have no SQL form; tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
