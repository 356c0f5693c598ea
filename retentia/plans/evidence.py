"""Evidence tables behind a selected view (O-122): the rows a reader sees, the selected
one marked, and how many rows stand behind it. Plain functions over published tables
(``tables.policy_metrics``, ``segment_metrics``, ``backtest``, ``decision_drift``). An
empty selection gives no marked row; budgets are percents, compared after rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.compare import simulate_policy_by_budget

CHARTS = ("budget_frontier", "backtest_stability", "decision_drift")


def _at(budget_pct: int) -> Column:
    return F.round(F.col("budget_k") * 100).cast("int") == F.lit(int(budget_pct))


def _counted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("evidence_rows", F.lit(rows.count()).cast("long"))


def policy_evidence(preds: DataFrame, budget_pct: int = 10, baseline: str = "policy_ml",
                    comparison: str = "policy_net_benefit") -> DataFrame:
    """One row: the two policies compared on the saved predictions at the budget."""
    sim = simulate_policy_by_budget(preds, [budget_pct / 100.0], baseline, comparison)
    return sim.withColumn("selected_budget", F.lit(int(budget_pct)))


def chart_evidence(rows: DataFrame, chart_type: str, budget_pct: int = 10) -> DataFrame:
    """A chart's rows; on the frontier the selected budget is marked."""
    if chart_type not in CHARTS:
        raise ValueError(f"Unknown chart: {chart_type}")
    mark = _at(budget_pct) if chart_type == "budget_frontier" else F.lit(False)
    return _counted(rows.withColumn("chart_type", F.lit(chart_type)).withColumn("is_selected", mark))


def segment_evidence(segments: DataFrame, segment_type: str, segment_value: str, split: str = "test") -> DataFrame:
    """The evaluation rows of one segment of a split."""
    return _counted(segments.filter((F.col("split") == split) & (F.col("segment_type") == segment_type)
                                    & F.col("segment_value").eqNullSafe(F.lit(segment_value))))


def budget_tradeoff_evidence(frontier: DataFrame, budget_pct: int = 10) -> DataFrame:
    """The model's frontier over all budgets with the selected one marked."""
    return chart_evidence(frontier, "budget_frontier", budget_pct).drop("chart_type")


def recommendation_evidence(frontier: DataFrame, model: str, budget_pct: int = 10,
                            policy: str = "policy_net_benefit") -> DataFrame:
    """The frontier with what was selected: budget, policy and model."""
    return (budget_tradeoff_evidence(frontier, budget_pct).withColumn("selected_budget", F.lit(int(budget_pct)))
            .withColumn("selected_policy", F.lit(policy)).withColumn("selected_model", F.lit(model)))


def risk_evidence(frontier: DataFrame, decision_drift: DataFrame, backtest: DataFrame,
                  budget_pct: int = 10) -> DataFrame:
    """The frontier with the number of drift and backtest rows that bear on its risk."""
    return (budget_tradeoff_evidence(frontier, budget_pct)
            .withColumn("decision_drift_rows", F.lit(decision_drift.count()).cast("long"))
            .withColumn("backtest_rows", F.lit(backtest.count()).cast("long")))
