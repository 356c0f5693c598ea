"""The minimum end-to-end slice: at-risk value held by the top 10 % of
customer-months under each policy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.evaluate import policy_metrics
from .common import normalise, scored


def value_at_risk_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    m = policy_metrics(s, [0.10], include_random=False)
    return normalise(m.select("policy", "budget_k", "targeted_count", "captured_churners",
                              "value_at_risk", "total_value_at_risk", "var_covered_frac"))
