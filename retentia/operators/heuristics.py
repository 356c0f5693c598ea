"""Heuristic baselines and decision policies (O-43..O-46, O-58, O-59b)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DecisionConfig
from ..functions.columns import minmax_expr
from .rank import average_ranks


def column_bounds(df: DataFrame, cols: list[str]) -> dict[str, tuple]:
    """min / max of several columns in one aggregate (one row to the driver)."""
    if not cols:
        return {}
    row = df.agg(*[F.min(c).alias(f"mn_{c}") for c in cols],
                 *[F.max(c).alias(f"mx_{c}") for c in cols]).first()
    return {c: (row[f"mn_{c}"], row[f"mx_{c}"]) for c in cols}


def minmax(df: DataFrame, col: str, out_col: str) -> DataFrame:
    """Scale over the frame being scored; constant or empty -> 0 (O-43).
    Note (reference behaviour): results depend on the batch."""
    lo, hi = column_bounds(df, [col])[col]
    return df.withColumn(out_col, minmax_expr(F.col(col), lo, hi))


def add_recency_baseline(df: DataFrame) -> DataFrame:
    return minmax(df, "gap_days_prev", "recency_risk")


def add_rfm_baseline(df: DataFrame, corrected: bool = False) -> DataFrame:
    """rfm_risk = mean of scaled rank terms. The reference ranks frequency and
    monetary descending *and* then inverts them, so frequent / high-spend rows get
    high risk; ``corrected=True`` flips that. All three ranks come from one
    grouped prefix sum over distinct values."""
    out, b = average_ranks(df, [("gap_days_prev", "r_rank", True), ("freq_90d", "f_rank", corrected),
                                ("rev_sum_90d", "m_rank", corrected)])
    r = minmax_expr(F.col("r_rank"), *b.get("r_rank", (None, None)))
    f = F.lit(1.0) - minmax_expr(F.col("f_rank"), *b.get("f_rank", (None, None)))
    m = F.lit(1.0) - minmax_expr(F.col("m_rank"), *b.get("m_rank", (None, None)))
    return out.withColumn("rfm_risk", (r + f + m) / 3.0)


def add_heuristics(df: DataFrame, corrected: bool = False) -> DataFrame:
    return add_rfm_baseline(add_recency_baseline(df), corrected)


def add_value_pos(df: DataFrame) -> DataFrame:
    if "rev_sum_90d" not in df.columns:
        raise ValueError("value_pos is made from rev_sum_90d, which is not there")
    return (df.withColumn("value_proxy", F.col("rev_sum_90d"))
              .withColumn("value_pos", F.greatest(F.col("rev_sum_90d"), F.lit(0.0))))


def _clip(c, lo: float, hi: float):
    return F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi)))


def add_customer_assumptions(df: DataFrame, cfg: DecisionConfig) -> DataFrame:
    """Per-row success rate and cost, flat or heterogeneous (O-58b)."""
    h = cfg.heterogeneity
    if not h.enabled:
        return (df.withColumn("assumed_success_rate_customer", F.lit(float(cfg.assumed_success_rate)))
                  .withColumn("intervention_cost_customer", F.lit(float(cfg.intervention_cost))))
    cols = ["value_pos"] + (["freq_90d"] if "freq_90d" in df.columns else [])
    b = column_bounds(df, cols)
    recency = F.col("recency_risk").cast("double") if "recency_risk" in df.columns else F.lit(0.0)
    freq = minmax_expr(F.col("freq_90d"), *b["freq_90d"]) if "freq_90d" in df.columns else F.lit(0.0)
    value = minmax_expr(F.col("value_pos"), *b["value_pos"])
    success = _clip(1.0 + h.success_rate_recency_weight * recency - h.success_rate_frequency_weight * freq,
                    h.min_success_rate_multiplier, h.max_success_rate_multiplier)
    cost = _clip(1.0 + h.cost_value_weight * value + h.cost_frequency_weight * freq,
                 h.min_cost_multiplier, h.max_cost_multiplier)
    return (df.withColumn("assumed_success_rate_customer", F.lit(float(cfg.assumed_success_rate)) * success)
              .withColumn("intervention_cost_customer", F.lit(float(cfg.intervention_cost)) * cost))


def add_policy_scores(df: DataFrame, cfg: DecisionConfig | None = None) -> DataFrame:
    """value_pos, per-row economics and every policy whose inputs exist (O-58)."""
    cfg = cfg or DecisionConfig()
    out = add_customer_assumptions(add_value_pos(df), cfg)
    if "churn_prob" in out.columns:
        erv = (F.col("churn_prob") * F.col("value_pos") * F.col("assumed_success_rate_customer")
               * F.lit(float(cfg.retention_value_multiplier)))
        out = (out.withColumn("policy_ml", F.col("churn_prob") * F.col("value_pos"))
                  .withColumn("expected_retained_value", erv)
                  .withColumn("expected_cost", F.col("intervention_cost_customer"))
                  .withColumn("policy_net_benefit", F.col("expected_retained_value") - F.col("expected_cost")))
    if "recency_risk" in out.columns:
        out = out.withColumn("policy_recency", F.col("recency_risk") * F.col("value_pos"))
    if "rfm_risk" in out.columns:
        out = out.withColumn("policy_rfm", F.col("rfm_risk") * F.col("value_pos"))
    return (out.withColumn("decision_simulation_assumption_driven", F.lit(True))
               .withColumn("decision_targeting_policy", F.lit(cfg.targeting_policy)))


def recommended_action(df: DataFrame) -> DataFrame:
    """Action per row (O-59b): positive net benefit -> outreach; else high risk
    (p >= 0.5) with low return; else review."""
    # The reference's action labels.
    return df.withColumn(
        "recommended_action",
        F.when(F.col("policy_net_benefit") > 0, F.lit("prioritize_retention_outreach"))
         .when(F.col("churn_prob") >= 0.5, F.lit("high_risk_but_low_economic_return"))
         .otherwise(F.lit("review_before_contact")))


def stub_probability(df: DataFrame, scale: float = 500000.0) -> DataFrame:
    """Deterministic, SQL-checkable stand-in for a model score:
    p = clip(rev_sum_90d / scale, 0, 1)."""
    return df.withColumn("churn_prob", _clip(F.col("rev_sum_90d") / F.lit(scale), 0.0, 1.0))
