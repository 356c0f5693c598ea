"""What-if analysis on scored tables (O-67, O-70, O-94, O-95, O-97..O-100).

Id lists ("first 20 customers only selected by one policy") are bounded before
anything is collected: ids are numbered per budget with the skew-safe grouped
row number and only the first ``max_ids`` per budget are gathered."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ExperimentConfig
from ..functions.columns import safe_div, top_n
from .evaluate import TIE, policy_metrics
from .rank import grouped_row_number, policy_order

MAX_IDS = 20


def _ranked_long(df: DataFrame, policies: Sequence[str], keep: Sequence[str]) -> DataFrame:
    items = [F.struct(F.lit(p).alias("policy"), F.col(p).cast("double").alias("_score")) for p in policies]
    long = df.select(*keep, F.explode(F.array(*items)).alias("_p")).select(*keep, "_p.policy", "_p._score")
    return grouped_row_number(long, ["policy"], policy_order("_score", TIE), "_rank", "_n_rows")


def _budget_rows(ranked: DataFrame, budgets: Sequence[float]) -> DataFrame:
    ks = [float(k) for k in budgets]
    return (ranked.withColumn("budget_k", F.explode(F.array(*[F.lit(k) for k in ks])))
            .withColumn("_n", top_n(F.col("_n_rows"), F.col("budget_k")))
            .filter(F.col("_rank") <= F.col("_n")))


def _first_ids(df: DataFrame, group_cols: Sequence[str], order, id_col: str, out_col: str,
               max_ids: int = MAX_IDS) -> DataFrame:
    """Comma-joined first ``max_ids`` ids per group in ``order`` (bounded collect)."""
    r = grouped_row_number(df, group_cols, order, "_ir", None).filter(F.col("_ir") <= max_ids)
    return (r.groupBy(*group_cols)
             .agg(F.sort_array(F.collect_list(F.struct("_ir", id_col))).alias("_l"))
             .select(*group_cols, F.array_join(F.transform("_l", lambda s: s[id_col]), ",").alias(out_col)))


def policy_selection_overlap(df: DataFrame, budgets: Sequence[float], baseline: str = "policy_ml",
                             comparison: str = "policy_net_benefit") -> DataFrame:
    """Per budget: distinct customers selected by each policy, shared, only-one,
    overlap share (over n rows, as in the reference) and row-level overlap (O-67)."""
    ranked = _ranked_long(df, [baseline, comparison], TIE)
    sel = _budget_rows(ranked, budgets)
    rows = sel.groupBy("budget_k", *TIE).agg(
        F.max((F.col("policy") == baseline).cast("int")).alias("_b"),
        F.max((F.col("policy") == comparison).cast("int")).alias("_c"),
        F.max("_n").alias("_n"))
    row_level = rows.groupBy("budget_k").agg(
        F.sum(F.col("_b") * F.col("_c")).alias("shared_rows"), F.max("_n").alias("top_n"))
    cust = rows.groupBy("budget_k", "CustomerID").agg(F.max("_b").alias("_b"), F.max("_c").alias("_c"))
    cust_level = cust.groupBy("budget_k").agg(
        F.sum(F.col("_b") * F.col("_c")).alias("shared_customers"),
        F.sum(F.col("_b") * (1 - F.col("_c"))).alias("n_selected_only_baseline"),
        F.sum(F.col("_c") * (1 - F.col("_b"))).alias("n_selected_only_comparison"))
    out = cust_level.join(row_level, "budget_k")
    return out.select(
        "budget_k", F.col("top_n").cast("long").alias("top_n"),
        F.col("shared_customers").cast("long").alias("shared_customers"),
        F.col("n_selected_only_baseline").cast("long").alias("n_selected_only_baseline"),
        F.col("n_selected_only_comparison").cast("long").alias("n_selected_only_comparison"),
        (F.col("shared_customers") / F.col("top_n")).alias("selection_overlap_at_k"),
        (F.col("shared_rows") / F.col("top_n")).alias("row_overlap_at_k"))


def simulate_policy_by_budget(df: DataFrame, budgets: Sequence[float], baseline: str = "policy_ml",
                              comparison: str = "policy_net_benefit") -> DataFrame:
    """Two policies side by side per budget (O-94)."""
    ranked = _ranked_long(df, [baseline, comparison], TIE)
    per_row = ranked.groupBy(*TIE).agg(
        F.max(F.when(F.col("policy") == baseline, F.col("_rank"))).alias("_rb"),
        F.max(F.when(F.col("policy") == comparison, F.col("_rank"))).alias("_rc"))
    changed = per_row.agg(F.sum((F.col("_rb") != F.col("_rc")).cast("long")).alias("n_customers_rank_changed"),
                          F.count(F.lit(1)).alias("_rows")).first()
    n_changed, n_rows = int(changed["n_customers_rank_changed"] or 0), int(changed["_rows"] or 0)

    metrics = policy_metrics(df, budgets, [baseline, comparison], include_random=False)
    piv = metrics.groupBy("budget_k").agg(
        F.max(F.when(F.col("policy") == baseline, F.col("value_at_risk"))).alias("value_at_risk_baseline"),
        F.max(F.when(F.col("policy") == comparison, F.col("value_at_risk"))).alias("value_at_risk_comparison"),
        F.max(F.when(F.col("policy") == baseline, F.col("net_benefit_at_k"))).alias("baseline_net_benefit_at_k"),
        F.max(F.when(F.col("policy") == comparison, F.col("net_benefit_at_k"))).alias("comparison_net_benefit_at_k"))

    sel = _budget_rows(ranked, budgets)
    cust = (sel.groupBy("budget_k", "CustomerID")
               .agg(F.max((F.col("policy") == baseline).cast("int")).alias("_b"),
                    F.max((F.col("policy") == comparison).cast("int")).alias("_c"))
               .withColumn("_id", F.col("CustomerID").cast("string")))
    counts = cust.groupBy("budget_k").agg(
        F.sum(F.col("_b") * F.col("_c")).alias("_shared"),
        F.sum(F.col("_b") * (1 - F.col("_c"))).cast("long").alias("n_selected_only_baseline"),
        F.sum(F.col("_c") * (1 - F.col("_b"))).cast("long").alias("n_selected_only_comparison"))
    only_b = _first_ids(cust.filter((F.col("_b") == 1) & (F.col("_c") == 0)), ["budget_k"],
                        [F.col("_id")], "_id", "selected_only_baseline_customer_ids")
    only_c = _first_ids(cust.filter((F.col("_c") == 1) & (F.col("_b") == 0)), ["budget_k"],
                        [F.col("_id")], "_id", "selected_only_comparison_customer_ids")
    tn = F.greatest(F.lit(1).cast("long"), F.bround(F.lit(float(n_rows)) * F.col("budget_k"), 0).cast("long"))
    differ = (F.col("n_selected_only_baseline") > 0) | (F.col("n_selected_only_comparison") > 0)
    out = (piv.join(counts, "budget_k", "left").join(only_b, "budget_k", "left").join(only_c, "budget_k", "left"))
    return out.select(
        "budget_k", F.lit(True).alias("assumption_driven"),
        F.lit(baseline).alias("baseline_policy"), F.lit(comparison).alias("comparison_policy"),
        differ.alias("ranking_changed"),
        F.lit(n_changed).cast("long").alias("n_customers_rank_changed"),
        F.lit(n_changed / n_rows if n_rows else 0.0).alias("pct_customers_rank_changed"),
        "value_at_risk_baseline", "value_at_risk_comparison", "baseline_net_benefit_at_k",
        "comparison_net_benefit_at_k",
        (F.col("comparison_net_benefit_at_k") - F.col("baseline_net_benefit_at_k")).alias("comparison_minus_baseline"),
        differ.alias("selected_customers_differ"),
        (F.col("_shared") / tn).alias("selection_overlap_at_k"),
        "n_selected_only_baseline", "n_selected_only_comparison",
        F.coalesce("selected_only_baseline_customer_ids", F.lit("")).alias("selected_only_baseline_customer_ids"),
        F.coalesce("selected_only_comparison_customer_ids", F.lit("")).alias("selected_only_comparison_customer_ids"))


def simulate_experiment_by_budget(df: DataFrame, budgets: Sequence[float],
                                  cfg: ExperimentConfig | None = None) -> DataFrame:
    """Rank-ordered treatment / control arms inside each budget's top-k (O-95).
    The best-ranked rows are treated; the control total is fixed at 0."""
    cfg = cfg or ExperimentConfig()
    need = ["CustomerID", "churn_prob", "value_pos", "assumed_success_rate_customer",
            "expected_retained_value", cfg.targeting_policy]
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ValueError(f"an experiment needs these columns too: {missing}")
    for k in budgets:
        if not (0 < float(k) <= 1):
            raise ValueError("a budget is a share above 0 and up to 1")
    uplift = F.least(F.greatest(F.col("churn_prob") * F.col("assumed_success_rate_customer")
                                * F.lit(float(cfg.treatment_effect_multiplier)), F.lit(0.0)), F.lit(1.0))
    prep = (df.withColumn("_u", uplift).withColumn("_d", F.col("_u") * F.col("value_pos"))
              .select(*TIE, "_u", "_d", F.col(cfg.targeting_policy).alias("_score")))
    ranked = grouped_row_number(prep, [], policy_order("_score", TIE), "_rank", "_n_rows")
    sel = _budget_rows(ranked, budgets)
    treat_n = F.greatest(F.lit(1).cast("long"),
                         F.bround(F.col("_n").cast("double") * F.lit(float(cfg.treatment_allocation_rate)), 0).cast("long"))
    sel = sel.withColumn("_tn", treat_n).withColumn("_treated", F.col("_rank") <= F.col("_tn"))
    agg = sel.groupBy("budget_k").agg(
        F.max("_n").alias("targeted_customers"), F.max("_tn").alias("treatment_customers"),
        F.sum(F.when(F.col("_treated"), F.col("_d"))).alias("_tot"),
        F.avg(F.when(F.col("_treated"), F.col("_d"))).alias("_avg_d"),
        F.avg(F.when(F.col("_treated"), F.col("_u"))).alias("_avg_u"))
    ids = sel.withColumn("_id", F.col("CustomerID").cast("string"))
    top_t = _first_ids(ids.filter("_treated"), ["budget_k"], [F.col("_rank")], "_id", "top_treated_customer_ids")
    top_c = _first_ids(ids.filter(~F.col("_treated")), ["budget_k"], [F.col("_rank")], "_id", "top_control_customer_ids")
    out = agg.join(top_t, "budget_k", "left").join(top_c, "budget_k", "left")
    tot = F.coalesce(F.col("_tot"), F.lit(0.0))
    return out.select(
        "budget_k", F.lit(True).alias("assumption_driven"),
        F.lit(cfg.targeting_policy).alias("targeting_policy"),
        F.lit(float(cfg.treatment_allocation_rate)).alias("treatment_allocation_rate"),
        F.lit(float(cfg.treatment_effect_multiplier)).alias("treatment_effect_multiplier"),
        F.col("targeted_customers").cast("long").alias("targeted_customers"),
        F.col("treatment_customers").cast("long").alias("treatment_customers"),
        (F.col("targeted_customers") - F.col("treatment_customers")).cast("long").alias("control_customers"),
        tot.alias("treatment_expected_incremental_retained_value"),
        F.lit(0.0).alias("control_expected_incremental_retained_value"),
        tot.alias("incremental_retained_value"),
        F.coalesce(F.col("_avg_d"), F.lit(0.0)).alias("average_incremental_retained_value_per_treated_customer"),
        F.coalesce(F.col("_avg_u"), F.lit(0.0)).alias("average_uplift_probability_treatment"),
        F.coalesce(F.col("_avg_u"), F.lit(0.0)).alias("uplift_style_difference_vs_control"),
        F.coalesce("top_treated_customer_ids", F.lit("")).alias("top_treated_customer_ids"),
        F.coalesce("top_control_customer_ids", F.lit("")).alias("top_control_customer_ids"))


def assumption_sensitivity(df: DataFrame, budgets: Sequence[float],
                           scenarios: Sequence[tuple[float, float]],
                           targeting_policy: str = "policy_net_benefit") -> DataFrame:
    """Re-price each budget's target list under (intervention cost, success rate)
    scenarios; 'holds' when the scenario keeps >= 90 % of the saved net benefit (O-97).
    The data is aggregated once per budget; scenarios multiply only those rows."""
    ranked = _ranked_long(df.select(*TIE, targeting_policy, "expected_retained_value",
                                    "assumed_success_rate_customer", "policy_net_benefit"),
                          [targeting_policy], [*TIE, "expected_retained_value",
                                               "assumed_success_rate_customer", "policy_net_benefit"])
    sel = _budget_rows(ranked, budgets)
    per_budget = sel.groupBy("budget_k").agg(
        F.count(F.lit(1)).alias("targeted_customers"),
        F.sum(F.col("expected_retained_value")
              / F.greatest(F.col("assumed_success_rate_customer"), F.lit(1e-6))).alias("_s"),
        F.sum("policy_net_benefit").alias("saved_net_benefit"))
    grid = F.explode(F.array(*[F.struct(F.lit(float(c)).alias("intervention_cost"),
                                        F.lit(float(r)).alias("success_rate")) for c, r in scenarios]))
    out = per_budget.withColumn("_sc", grid).select("*", "_sc.intervention_cost", "_sc.success_rate")
    adj = F.col("_s") * F.col("success_rate")
    cost = F.col("targeted_customers") * F.col("intervention_cost")
    return out.select(
        "budget_k", "intervention_cost", "success_rate", F.col("targeted_customers").cast("long").alias("targeted_customers"),
        adj.alias("adjusted_retained_value"), cost.alias("total_cost"), (adj - cost).alias("net_benefit"),
        "saved_net_benefit",
        ((adj - cost) >= F.col("saved_net_benefit") * 0.9).alias("recommendation_holds"))


def frontier_delta(frontier: DataFrame, selected_policy: str = "policy_net_benefit",
                   baseline_policy: str = "policy_ml") -> DataFrame:
    """Selected vs baseline frontier per budget: delta, pct improvement and the
    best budget of the selected policy (O-98). Input: policy_metrics rows."""
    sel = frontier.filter(F.col("policy") == selected_policy).select(
        "budget_k", F.col("net_benefit_at_k").alias("net_benefit_at_k"))
    base = frontier.filter(F.col("policy") == baseline_policy).select(
        "budget_k", F.col("net_benefit_at_k").alias("baseline_net_benefit_at_k"))
    best = sel.agg(F.max_by("budget_k", "net_benefit_at_k").alias("best_budget_k"))
    j = sel.join(base, "budget_k", "left")
    delta = F.coalesce(F.col("net_benefit_at_k") - F.col("baseline_net_benefit_at_k"), F.lit(0.0))
    j = j.withColumn("delta_vs_baseline", delta).withColumn(
        "pct_improvement",
        F.when(F.col("baseline_net_benefit_at_k").isNotNull() & (F.col("baseline_net_benefit_at_k") != 0),
               delta / F.abs(F.col("baseline_net_benefit_at_k"))))
    best_k = best.first()["best_budget_k"]
    return j.withColumn("is_best_budget", F.col("budget_k") == F.lit(best_k))


def segment_contribution(seg_rows: DataFrame, chosen_policy: str = "policy_net_benefit",
                         baseline_policy: str = "policy_ml") -> DataFrame:
    """Share of positive net benefit per segment, delta vs the baseline policy's
    segment row, negative-ROI flag (O-99). Input: segment metric rows with a
    ``policy`` column."""
    g = ["segment_type", "segment_value"]
    chosen = seg_rows.filter(F.col("policy") == chosen_policy).select(*g, "budget_k", "net_benefit_at_k")
    base = seg_rows.filter(F.col("policy") == baseline_policy).select(
        *g, "budget_k", F.col("net_benefit_at_k").alias("_base_nb"))
    j = chosen.join(base, [*g, "budget_k"], "left")
    pos = F.greatest(F.col("net_benefit_at_k"), F.lit(0.0))
    totals = j.groupBy("segment_type", "budget_k").agg(F.sum(pos).alias("_pos_total"))
    j = j.join(totals, ["segment_type", "budget_k"], "left")
    return j.select(*g, "budget_k", "net_benefit_at_k",
                    F.coalesce(F.col("net_benefit_at_k") - F.col("_base_nb"), F.lit(0.0)).alias("delta_vs_baseline"),
                    safe_div(pos, F.col("_pos_total")).alias("contribution_share"),
                    (F.col("net_benefit_at_k") < 0).alias("negative_roi"))


def rank_percentile(df: DataFrame, policy_col: str = "policy_net_benefit") -> DataFrame:
    """1 - (rank - 1) / n within the (filtered) table (O-70)."""
    ranked = grouped_row_number(df, [], policy_order(policy_col, TIE), "_rank", "_n_rows")
    return ranked.withColumn(
        "rank_percentile", F.lit(1.0) - (F.col("_rank") - 1).cast("double") / F.col("_n_rows")
    ).withColumnRenamed("_rank", "policy_rank").drop("_n_rows")


def champion_vs_runner_up(comparison: DataFrame, metric: str = "test_net_benefit_at_k") -> DataFrame:
    """The two best models by a comparison metric, side by side (O-100). The
    comparison table has one row per model."""
    from pyspark.sql import Window
    w = Window.orderBy(F.col(metric).desc_nulls_last(), "model")  # one row per model
    r = comparison.withColumn("_pos", F.row_number().over(w)).filter(F.col("_pos") <= 2)
    return r.groupBy().agg(
        F.max(F.when(F.col("_pos") == 1, F.col("model"))).alias("champion"),
        F.max(F.when(F.col("_pos") == 2, F.col("model"))).alias("runner_up"),
        F.max(F.when(F.col("_pos") == 1, F.col(metric))).alias("champion_value"),
        F.max(F.when(F.col("_pos") == 2, F.col(metric))).alias("runner_up_value")
    ).withColumn("gap", F.col("champion_value") - F.col("runner_up_value"))
