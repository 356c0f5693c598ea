"""Registered queries over the scored table: heuristics, policies, ranking,
evaluation, what-ifs and monitoring (with their DuckDB oracles)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import BUDGETS, ExperimentConfig
from ..operators import compare as C
from ..operators import evaluate as EV
from ..operators import monitor as M
from ..operators.heuristics import recommended_action
from ..operators.models import calibration_holdout
from ..operators.rank import rank_by_policy
from ..operators.selection import target_flags, target_lists, top_k_slice
from ..operators.split import prediction_output
from ..schemas import FEATURE_COLUMNS, TARGET_LIST_COLUMNS
from . import oracles as O
from .common import scored
from .evidence import budget_tradeoff_evidence
from .registry import KEYS, register

K = "(0.05, 0.10, 0.20)"
KS = "[0.05, 0.10, 0.20]"
R4 = O.r4


def _cols_sql(cols, src="sc", extra_where=""):
    sel = ["CustomerID", f"{O.month('invoice_month')} AS invoice_month"] + [f"{R4(c)} AS {c}" for c in cols]
    return O.with_scored(f"SELECT {', '.join(sel)} FROM {src} {extra_where}")


def _cols_query(name, cols):
    @register(name, _cols_sql(cols))
    def q(spark, sf):
        return scored(spark, sf).select(*KEYS, *cols)
    return q


_cols_query("minmax_recency", ["recency_risk"])
_cols_query("average_ranks", ["r_rank", "f_rank", "m_rank"])
_cols_query("rfm_risk", ["rfm_risk"])
_cols_query("value_pos", ["value_pos"])
_cols_query("customer_assumptions", ["assumed_success_rate_customer", "intervention_cost_customer"])
_cols_query("policy_scores", ["churn_prob", "policy_ml", "expected_retained_value", "expected_cost",
                              "policy_net_benefit", "policy_recency", "policy_rfm"])


# A risk that falls with revenue, so that all three actions occur.
_RISK = "greatest(1.0 - rev_sum_90d / 200000.0, 0.0)"
_RISK_BENEFIT = f"{_RISK} * value_pos * assumed_success_rate_customer - intervention_cost_customer"


@register("recommended_action", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, "
    f"CASE WHEN {_RISK_BENEFIT} > 0 THEN 'prioritize_retention_outreach' "
    f"WHEN {_RISK} >= 0.5 THEN 'high_risk_but_low_economic_return' ELSE 'review_before_contact' END "
    "AS recommended_action FROM sc"))
def q_action(spark, sf):
    s = scored(spark, sf).withColumn("churn_prob", F.greatest(
        F.lit(1.0) - F.col("rev_sum_90d") / F.lit(200000.0), F.lit(0.0)))
    s = s.withColumn("policy_net_benefit", F.col("churn_prob") * F.col("value_pos")
                     * F.col("assumed_success_rate_customer") - F.col("intervention_cost_customer"))
    return recommended_action(s).select(*KEYS, "recommended_action")


@register("top_k_slice", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {R4('policy_net_benefit')} AS policy_net_benefit "
    f"FROM (SELECT *, {O.rank_expr('policy_net_benefit')} AS r, count(*) OVER () AS n FROM sc) "
    f"WHERE r <= {O.topn('n', '0.10')}"))
def q_top_k(spark, sf):
    """The best tenth of customer-months by net benefit (O-61)."""
    return top_k_slice(scored(spark, sf), "policy_net_benefit", 0.10, digits=6).select(*KEYS, "policy_net_benefit")


@register("temporal_split_counts", O.with_scored(
    f"SELECT split, count(*) AS n_rows, CAST(sum(churn_90d) AS BIGINT) AS n_churn, "
    f"{R4('avg(churn_90d)')} AS churn_rate FROM sc GROUP BY split"))
def q_split(spark, sf):
    return scored(spark, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("churn_90d").cast("long").alias("n_churn"),
        F.avg("churn_90d").alias("churn_rate"))


@register("global_rank", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, "
    f"{O.rank_expr('policy_net_benefit')} AS policy_rank FROM sc"))
def q_rank(spark, sf):
    return rank_by_policy(scored(spark, sf), "policy_net_benefit", "policy_rank").select(*KEYS, "policy_rank")


@register("target_flags", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, "
    + ", ".join(f"CAST(r <= {O.topn('n', k)} AS BIGINT) AS target_k{p}"
                for k, p in [("0.05", "05"), ("0.10", "10"), ("0.20", "20")])
    + " FROM (SELECT *, " + O.rank_expr("policy_net_benefit") + " AS r, count(*) OVER () AS n FROM sc)"))
def q_flags(spark, sf):
    return target_flags(scored(spark, sf), "policy_net_benefit", BUDGETS, digits=6).select(
        *KEYS, "target_k05", "target_k10", "target_k20")


_TL = [c for c in TARGET_LIST_COLUMNS if c not in ("CustomerID", "invoice_month", "T", "decision_targeting_policy")]


@register("target_lists", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {O.ts('T')} AS T, "
    "decision_targeting_policy, CAST(round(b * 100) AS BIGINT) AS budget_pct, "
    + ", ".join(f"{R4(c)} AS {c}" for c in _TL)
    + " FROM (SELECT *, 'policy_net_benefit' AS decision_targeting_policy, "
    + O.rank_expr("policy_net_benefit") + f" AS r, count(*) OVER () AS n FROM sc), (SELECT unnest({KS}) AS b) "
    f"WHERE r <= {O.topn('n', 'b')}"))
def q_targets(spark, sf):
    s = scored(spark, sf)
    out = target_lists(target_flags(s, "policy_net_benefit", BUDGETS, digits=6), BUDGETS)
    return out.select(*TARGET_LIST_COLUMNS, F.round(F.col("budget_k") * 100).cast("long").alias("budget_pct"))


@register("rank_percentile", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, r AS policy_rank, "
    f"{R4('1.0 - (r - 1) / n')} AS rank_percentile FROM (SELECT *, {O.rank_expr('policy_net_benefit')} AS r, "
    "CAST(count(*) OVER () AS DOUBLE) AS n FROM sc WHERE split = 'test')"))
def q_pct(spark, sf):
    return C.rank_percentile(scored(spark, sf).filter(F.col("split") == "test")).select(
        *KEYS, "policy_rank", "rank_percentile")


@register("prediction_output", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {O.ts('T')} AS T, "
    + ", ".join(f"{R4(c)} AS {c}" for c in ["churn_prob", "value_pos", "policy_ml", "assumed_success_rate_customer",
                                            "intervention_cost_customer", "expected_retained_value",
                                            "expected_cost", "policy_net_benefit"])
    + ", CAST(1 AS BIGINT) AS decision_simulation_assumption_driven FROM sc"))
def q_pred(spark, sf):
    return prediction_output(scored(spark, sf))


# ------------------------------------------------------------------ evaluation

POLICIES = ["policy_ml", "policy_net_benefit", "policy_recency", "policy_rfm"]


RANDOM_SQL = ("CAST(('0x' || substr(md5('42|' || CAST(CustomerID AS BIGINT) || '|' "
              "|| strftime(invoice_month, '%Y-%m')), 1, 8))::BIGINT AS DOUBLE)")


def _long_sql(where: str = "split IS NOT NULL", group: str = "split", scores: dict | None = None) -> str:
    """Policy metrics for the 4 policies (or given score expressions) x 3 budgets
    per group, in SQL."""
    scores = scores or {p: p for p in POLICIES}
    union = " UNION ALL ".join(
        f"SELECT {group}, CustomerID, invoice_month, churn_90d, value_pos, policy_net_benefit, "
        f"'{p}' AS policy, {e} AS score FROM sc WHERE {where}" for p, e in scores.items())
    return f"""lg AS ({union}),
rkd AS (SELECT *, row_number() OVER (PARTITION BY {group}, policy ORDER BY round(score, 6) DESC NULLS LAST,
          CustomerID, invoice_month) AS r, count(*) OVER (PARTITION BY {group}, policy) AS n FROM lg),
tot AS (SELECT {group}, count(*) AS rows_, sum(churn_90d) AS pos_,
          coalesce(sum(CASE WHEN churn_90d = 1 THEN value_pos END), 0.0) AS tvar FROM sc WHERE {where} GROUP BY {group}),
top AS (SELECT rkd.*, b AS budget_k FROM rkd, (SELECT unnest({KS}) AS b) WHERE r <= {O.topn('n', 'b')}),
pm AS (SELECT top.{group}, policy, budget_k, count(*) AS targeted_count, CAST(sum(churn_90d) AS BIGINT) AS captured_churners,
          coalesce(sum(CASE WHEN churn_90d = 1 THEN value_pos END), 0.0) AS value_at_risk,
          sum(policy_net_benefit) AS net_benefit_at_k, max(tvar) AS total_value_at_risk, max(rows_) AS rows_, max(pos_) AS pos_
       FROM top JOIN tot ON top.{group} IS NOT DISTINCT FROM tot.{group} GROUP BY top.{group}, policy, budget_k)"""


def _pm_select(group: str, cols: list[str]) -> str:
    exprs = {
        "value_at_risk": R4("value_at_risk"), "net_benefit_at_k": R4("net_benefit_at_k"),
        "total_value_at_risk": R4("total_value_at_risk"),
        "var_covered_frac": R4("CASE WHEN total_value_at_risk > 0 THEN value_at_risk / total_value_at_risk ELSE 0.0 END"),
        "targeted_count": "targeted_count", "captured_churners": "captured_churners",
        "precision_at_k": R4("captured_churners / targeted_count"),
        "recall_at_k": R4("CASE WHEN pos_ > 0 THEN captured_churners / pos_ ELSE 0.0 END"),
        "lift_at_k": R4("CASE WHEN pos_ > 0 THEN (captured_churners / targeted_count) / (pos_ / rows_) ELSE 0.0 END"),
        "assumption_driven": "CAST(1 AS BIGINT)",
    }
    return f"SELECT {group}, policy, {R4('budget_k')} AS budget_k, " + ", ".join(f"{exprs[c]} AS {c}" for c in cols) + " FROM pm"


PM_ALL = ["value_at_risk", "net_benefit_at_k", "total_value_at_risk", "var_covered_frac", "assumption_driven",
          "targeted_count", "captured_churners", "precision_at_k", "recall_at_k", "lift_at_k"]


def _pm_query(name: str, cols: list[str]):
    @register(name, O.with_scored(_pm_select("split", cols), _long_sql()))
    def q(spark, sf):
        s = scored(spark, sf).filter(F.col("split").isNotNull())
        m = EV.policy_metrics(s, BUDGETS, POLICIES, ["split"], include_random=False)
        return m.select("split", "policy", "budget_k", *cols)
    return q


_pm_query("policy_evaluation", PM_ALL)
_pm_query("value_at_risk", ["value_at_risk", "total_value_at_risk", "var_covered_frac"])
_pm_query("topk_class_metrics", ["targeted_count", "captured_churners", "precision_at_k", "recall_at_k", "lift_at_k"])
_pm_query("net_benefit", ["net_benefit_at_k"])


@register("frontier", O.with_scored(
    _pm_select("split", ["value_at_risk", "var_covered_frac", "net_benefit_at_k", "targeted_count",
                         "captured_churners", "precision_at_k", "recall_at_k", "lift_at_k"])
    + " WHERE policy = 'policy_net_benefit'", _long_sql()))
def q_frontier(spark, sf):
    s = scored(spark, sf).filter(F.col("split").isNotNull())
    return EV.policy_frontier(s, "policy_net_benefit", BUDGETS, ["split"])


_NB_B = "max(CASE WHEN policy = 'policy_ml' THEN net_benefit_at_k END)"
_NB_C = "max(CASE WHEN policy = 'policy_net_benefit' THEN net_benefit_at_k END)"


@register("net_benefit_comparison", O.with_scored(
    f"SELECT split, {R4('budget_k')} AS budget_k, {R4(_NB_B)} AS baseline_net_benefit_at_k, "
    f"{R4(_NB_C)} AS comparison_net_benefit_at_k, {R4(_NB_C + ' - ' + _NB_B)} AS comparison_minus_baseline "
    "FROM pm GROUP BY split, budget_k", _long_sql()))
def q_nbc(spark, sf):
    s = scored(spark, sf).filter(F.col("split").isNotNull())
    return EV.net_benefit_comparison(s, "policy_ml", "policy_net_benefit", BUDGETS, group_cols=["split"])


@register("heuristic_uplift", O.with_scored(
    f"SELECT split, {R4('budget_k')} AS budget_k, {R4('ml - best')} AS uplift_abs, "
    f"{R4('CASE WHEN best > 0 THEN (ml - best) / best ELSE 0.0 END')} AS uplift_pct FROM ("
    "SELECT split, budget_k, max(CASE WHEN policy = 'policy_ml' THEN value_at_risk END) AS ml, "
    "max(CASE WHEN policy IN ('policy_recency', 'policy_rfm') THEN value_at_risk END) AS best "
    "FROM pm GROUP BY split, budget_k)", _long_sql()))
def q_uplift(spark, sf):
    s = scored(spark, sf).filter(F.col("split").isNotNull())
    m = EV.policy_metrics(s, BUDGETS, POLICIES, ["split"], include_random=False)
    p = m.groupBy("split", "budget_k").agg(
        F.max(F.when(F.col("policy") == "policy_ml", F.col("value_at_risk"))).alias("ml"),
        F.max(F.when(F.col("policy").isin("policy_recency", "policy_rfm"), F.col("value_at_risk"))).alias("best"))
    return p.select("split", "budget_k", (F.col("ml") - F.col("best")).alias("uplift_abs"),
                    F.when(F.col("best") > 0, (F.col("ml") - F.col("best")) / F.col("best")).otherwise(0.0)
                    .alias("uplift_pct"))


@register("random_baseline", O.with_scored(_pm_select("split", PM_ALL),
                                           _long_sql(scores={"policy_random": RANDOM_SQL})))
def q_random(spark, sf):
    """Fixed-seed shuffled ranking as a policy (O-78)."""
    s = scored(spark, sf).filter(F.col("split").isNotNull())
    return EV.policy_metrics(s, BUDGETS, [], ["split"], include_random=True)


# ------------------------------------------------------------------ classification

def _cls_sql(where="split IS NOT NULL", group="split"):
    return f"""st AS (SELECT {group}, churn_prob AS score, sum(churn_90d) AS pos, count(*) AS cnt
                FROM sc WHERE {where} GROUP BY {group}, churn_prob),
cum AS (SELECT st.*, sum(pos) OVER (PARTITION BY {group} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(cnt) OVER (PARTITION BY {group} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS pp,
               sum(pos) OVER (PARTITION BY {group}) AS P, sum(cnt) OVER (PARTITION BY {group}) - sum(pos) OVER (PARTITION BY {group}) AS N
        FROM st)"""


@register("classification_summary", O.with_scored(
    f"""SELECT c.split, {R4('roc_auc')} AS roc_auc, {R4('pr_auc')} AS pr_auc, {R4('brier_score')} AS brier_score,
        {R4('positive_rate')} AS positive_rate FROM
      (SELECT split, sum((cnt - pos) * ((tp - pos) + pos / 2.0)) / (max(P) * max(N)) AS roc_auc,
              sum(pos * tp / pp) / max(P) AS pr_auc FROM cum GROUP BY split) c
      JOIN (SELECT split, avg((churn_prob - churn_90d) * (churn_prob - churn_90d)) AS brier_score,
                   avg(churn_90d) AS positive_rate FROM sc WHERE split IS NOT NULL GROUP BY split) b
      ON c.split = b.split""", _cls_sql()))
def q_cls(spark, sf):
    s = scored(spark, sf).filter(F.col("split").isNotNull())
    return EV.classification_summary(s, group_cols=["split"])


@register("roc_points", O.with_scored(
    f"SELECT split, {R4('CASE WHEN N > 0 THEN (pp - tp) / N ELSE 0.0 END')} AS fpr, "
    f"{R4('CASE WHEN P > 0 THEN tp / P ELSE 0.0 END')} AS tpr, {R4('score')} AS threshold FROM cum "
    "UNION ALL SELECT DISTINCT split, 0.0, 0.0, CAST('inf' AS DOUBLE) FROM cum", _cls_sql()))
def q_roc(spark, sf):
    s = scored(spark, sf).filter(F.col("split").isNotNull())
    return EV.roc_points(s, group_cols=["split"])


@register("pr_points", O.with_scored(
    f"SELECT split, {R4('tp / pp')} AS precision, {R4('CASE WHEN P > 0 THEN tp / P ELSE 0.0 END')} AS recall, "
    f"{R4('score')} AS threshold FROM cum "
    "UNION ALL SELECT DISTINCT split, 1.0, 0.0, CAST(NULL AS DOUBLE) FROM cum", _cls_sql()))
def q_pr(spark, sf):
    s = scored(spark, sf).filter(F.col("split").isNotNull())
    return EV.pr_points(s, group_cols=["split"])


@register("calibration_curve", O.with_scored(
    f"""SELECT s.split, CAST(len(list_filter(e.edges, lambda x: x < s.churn_prob)) AS BIGINT) AS bin,
        {R4('avg(s.churn_prob)')} AS mean_predicted_probability,
        {R4('avg(s.churn_90d)')} AS observed_positive_rate
      FROM sc s JOIN (SELECT split, quantile_cont(churn_prob, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
                      FROM sc WHERE split IS NOT NULL GROUP BY split) e ON s.split = e.split
      GROUP BY s.split, bin"""))
def q_calib(spark, sf):
    s = scored(spark, sf).filter(F.col("split").isNotNull())
    return EV.calibration_curve(s, group_cols=["split"])


# ------------------------------------------------------------------ segments

SEG_SQL = """seg AS (
  SELECT sc.*, t.segment_type,
    CASE t.segment_type
      WHEN 'segment_value_band' THEN CASE WHEN rev_sum_90d <= 50 THEN 'low_value' WHEN rev_sum_90d <= 200 THEN 'mid_value'
                                          WHEN rev_sum_90d IS NOT NULL THEN 'high_value' END
      WHEN 'segment_recency_bucket' THEN CASE WHEN gap_days_prev <= 30 THEN 'recent' WHEN gap_days_prev <= 90 THEN 'warming'
                                          WHEN gap_days_prev IS NOT NULL THEN 'stale' END
      ELSE CASE WHEN freq_90d <= 2 THEN 'low_frequency' WHEN freq_90d <= 5 THEN 'mid_frequency'
                WHEN freq_90d IS NOT NULL THEN 'high_frequency' END END AS segment_value
  FROM sc, (SELECT unnest(['segment_value_band', 'segment_recency_bucket', 'segment_frequency_bucket']) AS segment_type) t)"""


@register("segment_bands", O.with_scored(
    f"SELECT segment_type, segment_value, count(*) AS n_rows, {R4('avg(churn_90d)')} AS positive_rate "
    "FROM seg GROUP BY segment_type, segment_value", SEG_SQL))
def q_segbands(spark, sf):
    return EV.segment_long(scored(spark, sf)).groupBy("segment_type", "segment_value").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("churn_90d").alias("positive_rate"))


@register("segment_evaluation", O.with_scored(
    f"""SELECT k.segment_type, k.segment_value, k.n_rows, {R4('k.positive_rate')} AS positive_rate,
        {R4('c.roc_auc')} AS roc_auc, {R4('c.pr_auc')} AS pr_auc, {R4('c.brier_score')} AS brier_score,
        p.policy, {R4('p.budget_k')} AS budget_k, {R4('p.value_at_risk')} AS value_at_risk,
        {R4('CASE WHEN p.tvar > 0 THEN p.value_at_risk / p.tvar ELSE 0.0 END')} AS var_covered_frac,
        {R4('p.net_benefit_at_k')} AS net_benefit_at_k, p.targeted_count, p.captured_churners,
        {R4('p.captured_churners / p.targeted_count')} AS precision_at_k,
        {R4('CASE WHEN k.pos > 0 THEN p.captured_churners / k.pos ELSE 0.0 END')} AS recall_at_k,
        {R4('CASE WHEN k.pos > 0 THEN (p.captured_churners / p.targeted_count) / (k.pos / k.n_rows) ELSE 0.0 END')} AS lift_at_k
      FROM k
      JOIN (SELECT segment_type, segment_value,
                   sum((cnt - pos) * ((tp - pos) + pos / 2.0)) / (max(P) * max(N)) AS roc_auc,
                   sum(pos * tp / pp) / max(P) AS pr_auc, max(brier) AS brier_score FROM scum
            GROUP BY segment_type, segment_value) c USING (segment_type, segment_value)
      JOIN (SELECT segment_type, segment_value, 'policy_net_benefit' AS policy, 0.10 AS budget_k,
                   coalesce(sum(CASE WHEN churn_90d = 1 THEN value_pos END), 0.0) AS value_at_risk,
                   sum(policy_net_benefit) AS net_benefit_at_k, count(*) AS targeted_count,
                   CAST(sum(churn_90d) AS BIGINT) AS captured_churners, max(tvar) AS tvar
            FROM srk WHERE r <= {O.topn('n', '0.10')} GROUP BY segment_type, segment_value) p
      USING (segment_type, segment_value)""",
    SEG_SQL,
    """segt AS (SELECT * FROM seg WHERE split = 'test'),
k AS (SELECT segment_type, segment_value, count(*) AS n_rows, avg(churn_90d) AS positive_rate, sum(churn_90d) AS pos
      FROM segt GROUP BY segment_type, segment_value HAVING count(*) >= 5 AND count(DISTINCT churn_90d) >= 2),
sst AS (SELECT segment_type, segment_value, churn_prob AS score, sum(churn_90d) AS pos, count(*) AS cnt
        FROM segt GROUP BY segment_type, segment_value, churn_prob),
br AS (SELECT segment_type, segment_value, avg((churn_prob - churn_90d) * (churn_prob - churn_90d)) AS brier
       FROM segt GROUP BY segment_type, segment_value),
scum AS (SELECT sst.*, br.brier,
    sum(pos) OVER (PARTITION BY sst.segment_type, sst.segment_value ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
    sum(cnt) OVER (PARTITION BY sst.segment_type, sst.segment_value ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS pp,
    sum(pos) OVER (PARTITION BY sst.segment_type, sst.segment_value) AS P,
    sum(cnt - pos) OVER (PARTITION BY sst.segment_type, sst.segment_value) AS N
  FROM sst JOIN br USING (segment_type, segment_value)),
srk AS (SELECT segt.*, row_number() OVER (PARTITION BY segment_type, segment_value ORDER BY round(policy_net_benefit, 6)
          DESC NULLS LAST, CustomerID, invoice_month) AS r,
        count(*) OVER (PARTITION BY segment_type, segment_value) AS n,
        sum(CASE WHEN churn_90d = 1 THEN value_pos ELSE 0.0 END) OVER (PARTITION BY segment_type, segment_value) AS tvar
        FROM segt)"""))
def q_segeval(spark, sf):
    s = scored(spark, sf).filter(F.col("split") == "test")
    return EV.evaluate_segments(s, BUDGETS)


# ------------------------------------------------------------------ what-ifs

@register("decision_drift", O.with_scored(
    f"""SELECT {O.month('invoice_month')} AS invoice_month, {R4('b')} AS budget_k, 'policy_net_benefit' AS ranking_policy,
        max(n) AS n_rows, max({O.topn('n', 'b')}) AS selected_count, {R4(f"max({O.topn('n', 'b')}) / max(n)")} AS selected_share,
        {R4('avg(churn_prob)')} AS avg_churn_prob_top_k, {R4('avg(value_pos)')} AS avg_value_pos_top_k,
        {R4('coalesce(sum(CASE WHEN churn_90d = 1 THEN value_pos END), 0.0)')} AS var_at_k,
        {R4('avg(policy_net_benefit)')} AS avg_policy_net_benefit_top_k
      FROM (SELECT *, {O.rank_expr('policy_net_benefit', 'invoice_month')} AS r,
                   count(*) OVER (PARTITION BY invoice_month) AS n FROM sc), (SELECT unnest({KS}) AS b)
      WHERE r <= {O.topn('n', 'b')} GROUP BY invoice_month, b"""))
def q_ddrift(spark, sf):
    return M.decision_drift(scored(spark, sf), BUDGETS, "policy_net_benefit", digits=6)


def _sel_sql():
    return f"""rb AS (SELECT CustomerID, invoice_month, {O.rank_expr('policy_ml')} AS r, count(*) OVER () AS n FROM sc),
rc AS (SELECT CustomerID, invoice_month, {O.rank_expr('policy_net_benefit')} AS r, count(*) OVER () AS n FROM sc),
bud AS (SELECT unnest({KS}) AS b),
selb AS (SELECT DISTINCT b, CustomerID FROM rb, bud WHERE r <= {O.topn('n', 'b')}),
selc AS (SELECT DISTINCT b, CustomerID FROM rc, bud WHERE r <= {O.topn('n', 'b')}),
cu AS (SELECT coalesce(selb.b, selc.b) AS b, coalesce(selb.CustomerID, selc.CustomerID) AS CustomerID,
              selb.CustomerID IS NOT NULL AS in_b, selc.CustomerID IS NOT NULL AS in_c
       FROM selb FULL OUTER JOIN selc ON selb.b = selc.b AND selb.CustomerID = selc.CustomerID),
rowsb AS (SELECT b, CustomerID, invoice_month FROM rb, bud WHERE r <= {O.topn('n', 'b')}),
rowsc AS (SELECT b, CustomerID, invoice_month FROM rc, bud WHERE r <= {O.topn('n', 'b')}),
rowshared AS (SELECT b, count(*) AS shared_rows FROM rowsb JOIN rowsc USING (b, CustomerID, invoice_month) GROUP BY b),
ntop AS (SELECT b, max({O.topn('n', 'b')}) AS top_n FROM rb, bud GROUP BY b)"""


@register("policy_set_overlap", O.with_scored(
    f"""SELECT {R4('cu.b')} AS budget_k, max(ntop.top_n) AS top_n,
        CAST(sum(CASE WHEN in_b AND in_c THEN 1 ELSE 0 END) AS BIGINT) AS shared_customers,
        CAST(sum(CASE WHEN in_b AND NOT in_c THEN 1 ELSE 0 END) AS BIGINT) AS n_selected_only_baseline,
        CAST(sum(CASE WHEN in_c AND NOT in_b THEN 1 ELSE 0 END) AS BIGINT) AS n_selected_only_comparison,
        {R4('sum(CASE WHEN in_b AND in_c THEN 1 ELSE 0 END) / max(ntop.top_n)')} AS selection_overlap_at_k,
        {R4('coalesce(max(rowshared.shared_rows), 0) / max(ntop.top_n)')} AS row_overlap_at_k
      FROM cu JOIN ntop ON cu.b = ntop.b LEFT JOIN rowshared ON cu.b = rowshared.b GROUP BY cu.b""", _sel_sql()))
def q_overlap(spark, sf):
    return C.policy_selection_overlap(scored(spark, sf), BUDGETS)


@register("policy_comparison", O.with_scored(
    f"""SELECT {R4('cu.b')} AS budget_k, CAST(1 AS BIGINT) AS assumption_driven, 'policy_ml' AS baseline_policy,
        'policy_net_benefit' AS comparison_policy,
        CAST(sum(CASE WHEN in_b <> in_c THEN 1 ELSE 0 END) > 0 AS BIGINT) AS ranking_changed,
        max(ch.nch) AS n_customers_rank_changed, {R4('max(ch.nch) / max(ch.nrows)')} AS pct_customers_rank_changed,
        {R4('max(pmv.vb)')} AS value_at_risk_baseline, {R4('max(pmv.vc)')} AS value_at_risk_comparison,
        {R4('max(pmv.nb)')} AS baseline_net_benefit_at_k, {R4('max(pmv.nc)')} AS comparison_net_benefit_at_k,
        {R4('max(pmv.nc) - max(pmv.nb)')} AS comparison_minus_baseline,
        CAST(sum(CASE WHEN in_b <> in_c THEN 1 ELSE 0 END) > 0 AS BIGINT) AS selected_customers_differ,
        {R4('sum(CASE WHEN in_b AND in_c THEN 1 ELSE 0 END) / max(ntop.top_n)')} AS selection_overlap_at_k,
        CAST(sum(CASE WHEN in_b AND NOT in_c THEN 1 ELSE 0 END) AS BIGINT) AS n_selected_only_baseline,
        CAST(sum(CASE WHEN in_c AND NOT in_b THEN 1 ELSE 0 END) AS BIGINT) AS n_selected_only_comparison,
        coalesce(max(ib.ids), '') AS selected_only_baseline_customer_ids,
        coalesce(max(ic.ids), '') AS selected_only_comparison_customer_ids
      FROM cu JOIN ntop ON cu.b = ntop.b
      JOIN pmv ON cu.b = pmv.b
      LEFT JOIN (SELECT b, string_agg(id, ',' ORDER BY id) AS ids FROM (
          SELECT b, CAST(CustomerID AS VARCHAR) AS id, row_number() OVER (PARTITION BY b ORDER BY CAST(CustomerID AS VARCHAR)) AS q
          FROM cu WHERE in_b AND NOT in_c) WHERE q <= 20 GROUP BY b) ib ON cu.b = ib.b
      LEFT JOIN (SELECT b, string_agg(id, ',' ORDER BY id) AS ids FROM (
          SELECT b, CAST(CustomerID AS VARCHAR) AS id, row_number() OVER (PARTITION BY b ORDER BY CAST(CustomerID AS VARCHAR)) AS q
          FROM cu WHERE in_c AND NOT in_b) WHERE q <= 20 GROUP BY b) ic ON cu.b = ic.b,
      (SELECT CAST(sum(CASE WHEN rb.r <> rc.r THEN 1 ELSE 0 END) AS BIGINT) AS nch, count(*) AS nrows
       FROM rb JOIN rc USING (CustomerID, invoice_month)) ch
      GROUP BY cu.b""",
    _sel_sql(),
    f"""pmv AS (SELECT b,
        coalesce(sum(CASE WHEN w = 'b' AND churn_90d = 1 THEN value_pos END), 0.0) AS vb,
        coalesce(sum(CASE WHEN w = 'c' AND churn_90d = 1 THEN value_pos END), 0.0) AS vc,
        sum(CASE WHEN w = 'b' THEN policy_net_benefit END) AS nb, sum(CASE WHEN w = 'c' THEN policy_net_benefit END) AS nc
      FROM (SELECT 'b' AS w, b, sc.* FROM rb JOIN sc USING (CustomerID, invoice_month), bud WHERE r <= {O.topn('n', 'b')}
            UNION ALL
            SELECT 'c' AS w, b, sc.* FROM rc JOIN sc USING (CustomerID, invoice_month), bud WHERE r <= {O.topn('n', 'b')})
      GROUP BY b)"""))
def q_polcomp(spark, sf):
    return C.simulate_policy_by_budget(scored(spark, sf), BUDGETS)


@register("experiment_arms", O.with_scored(
    f"""SELECT {R4('b')} AS budget_k, CAST(1 AS BIGINT) AS assumption_driven, 'policy_net_benefit' AS targeting_policy,
        {R4('0.5')} AS treatment_allocation_rate, {R4('1.0')} AS treatment_effect_multiplier,
        max(tn) AS targeted_customers, max(trn) AS treatment_customers, max(tn) - max(trn) AS control_customers,
        {R4('coalesce(sum(CASE WHEN r <= trn THEN d END), 0.0)')} AS treatment_expected_incremental_retained_value,
        {R4('0.0')} AS control_expected_incremental_retained_value,
        {R4('coalesce(sum(CASE WHEN r <= trn THEN d END), 0.0)')} AS incremental_retained_value,
        {R4('coalesce(avg(CASE WHEN r <= trn THEN d END), 0.0)')} AS average_incremental_retained_value_per_treated_customer,
        {R4('coalesce(avg(CASE WHEN r <= trn THEN u END), 0.0)')} AS average_uplift_probability_treatment,
        {R4('coalesce(avg(CASE WHEN r <= trn THEN u END), 0.0)')} AS uplift_style_difference_vs_control,
        coalesce(string_agg(CASE WHEN r <= trn AND r <= 20 THEN CAST(CustomerID AS VARCHAR) END, ',' ORDER BY r), '') AS top_treated_customer_ids,
        coalesce(string_agg(CASE WHEN r > trn AND r <= trn + 20 THEN CAST(CustomerID AS VARCHAR) END, ',' ORDER BY r), '') AS top_control_customer_ids
      FROM (SELECT x.*, b, {O.topn('n', 'b')} AS tn,
                   greatest(1, CAST(round_even(CAST({O.topn('n', 'b')} AS DOUBLE) * 0.5, 0) AS BIGINT)) AS trn
            FROM (SELECT *, least(greatest(churn_prob * assumed_success_rate_customer * 1.0, 0.0), 1.0) AS u,
                         least(greatest(churn_prob * assumed_success_rate_customer * 1.0, 0.0), 1.0) * value_pos AS d,
                         {O.rank_expr('policy_net_benefit')} AS r, count(*) OVER () AS n FROM sc) x,
                 (SELECT unnest({KS}) AS b)) y
      WHERE r <= tn GROUP BY b"""))
def q_experiment(spark, sf):
    return C.simulate_experiment_by_budget(scored(spark, sf), BUDGETS, ExperimentConfig())


SCENARIOS = [(15.0, 0.15), (25.0, 0.20), (10.0, 0.10)]


@register("sensitivity_grid", O.with_scored(
    f"""SELECT {R4('b')} AS budget_k, {R4('c')} AS intervention_cost, {R4('s')} AS success_rate,
        max(tn) AS targeted_customers, {R4('sum(erv / greatest(asr, 1e-6)) * s')} AS adjusted_retained_value,
        {R4('max(tn) * c')} AS total_cost, {R4('sum(erv / greatest(asr, 1e-6)) * s - max(tn) * c')} AS net_benefit,
        {R4('sum(nb)')} AS saved_net_benefit,
        CAST(sum(erv / greatest(asr, 1e-6)) * s - max(tn) * c >= sum(nb) * 0.9 AS BIGINT) AS recommendation_holds
      FROM (SELECT expected_retained_value AS erv, assumed_success_rate_customer AS asr, policy_net_benefit AS nb,
                   {O.rank_expr('policy_net_benefit')} AS r, count(*) OVER () AS n FROM sc) x,
           (SELECT unnest({KS}) AS b) bb, (SELECT unnest([15.0, 25.0, 10.0]) AS c, unnest([0.15, 0.20, 0.10]) AS s) g,
           LATERAL (SELECT {O.topn('n', 'b')} AS tn)
      WHERE r <= tn GROUP BY b, c, s"""))
def q_sens(spark, sf):
    return C.assumption_sensitivity(scored(spark, sf), BUDGETS, SCENARIOS)


@register("frontier_delta", O.with_scored(
    f"""SELECT {R4('s.budget_k')} AS budget_k, {R4('s.net_benefit_at_k')} AS net_benefit_at_k,
        {R4('bl.net_benefit_at_k')} AS baseline_net_benefit_at_k,
        {R4('coalesce(s.net_benefit_at_k - bl.net_benefit_at_k, 0.0)')} AS delta_vs_baseline,
        {R4('CASE WHEN bl.net_benefit_at_k <> 0 THEN (s.net_benefit_at_k - bl.net_benefit_at_k) / abs(bl.net_benefit_at_k) END')} AS pct_improvement,
        CAST(s.budget_k = (SELECT arg_max(budget_k, net_benefit_at_k) FROM pm WHERE split = 'test' AND policy = 'policy_net_benefit') AS BIGINT) AS is_best_budget
      FROM (SELECT * FROM pm WHERE split = 'test' AND policy = 'policy_net_benefit') s
      LEFT JOIN (SELECT * FROM pm WHERE split = 'test' AND policy = 'policy_ml') bl ON s.budget_k = bl.budget_k""",
    _long_sql()))
def q_fdelta(spark, sf):
    s = scored(spark, sf).filter(F.col("split") == "test")
    fr = EV.policy_metrics(s, BUDGETS, ["policy_ml", "policy_net_benefit"], include_random=False)
    return C.frontier_delta(fr)


@register("budget_tradeoff_evidence", O.with_scored(
    f"""SELECT {R4('budget_k')} AS budget_k, {R4('net_benefit_at_k')} AS net_benefit_at_k,
        CAST(round(budget_k * 100) = 10 AS BIGINT) AS is_selected, count(*) OVER () AS evidence_rows
      FROM pm WHERE split = 'test' AND policy = 'policy_net_benefit'""", _long_sql()))
def q_tradeoff(spark, sf):
    """The test frontier with the 10 % budget selected (O-122)."""
    s = scored(spark, sf).filter(F.col("split") == "test")
    fr = EV.policy_metrics(s, BUDGETS, ["policy_net_benefit"], include_random=False)
    return budget_tradeoff_evidence(fr.select("budget_k", "net_benefit_at_k"), 10)


# ------------------------------------------------------------------ monitoring

def _drift_sql():
    unions = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, split FROM sc" for c in FEATURE_COLUMNS)
    return f"""lf AS ({unions}),
qe AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS u
       FROM lf WHERE split = 'train' AND value IS NOT NULL GROUP BY feature),
ed AS (SELECT feature, CASE WHEN len(u) > 2 THEN u[2:len(u) - 1] ELSE [] END AS edges FROM qe),
bins AS (SELECT feature, unnest(range(0, len(edges) + 1)) AS bin FROM ed),
refc AS (SELECT lf.feature, len(list_filter(ed.edges, lambda e: e <= lf.value)) AS bin, count(*) AS c
         FROM lf JOIN ed USING (feature) WHERE split = 'train' AND value IS NOT NULL GROUP BY 1, 2),
curc AS (SELECT lf.feature, len(list_filter(ed.edges, lambda e: e <= lf.value)) AS bin, count(*) AS c
         FROM lf JOIN ed USING (feature) WHERE value IS NOT NULL GROUP BY 1, 2),
pj AS (SELECT bins.feature, bins.bin, coalesce(refc.c, 0) + 1e-8 AS e, coalesce(curc.c, 0) + 1e-8 AS a
       FROM bins LEFT JOIN refc USING (feature, bin) LEFT JOIN curc USING (feature, bin)),
pn AS (SELECT feature, bin, e / sum(e) OVER (PARTITION BY feature) AS e, a / sum(a) OVER (PARTITION BY feature) AS a FROM pj),
psi AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM pn GROUP BY feature),
st AS (SELECT feature, part, count(*) AS n_rows, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate,
       avg(value) AS mean, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.9) AS p90, quantile_cont(value, 0.99) AS p99
       FROM (SELECT feature, value, 'current' AS part FROM lf
             UNION ALL SELECT feature, value, 'reference' FROM lf WHERE split = 'train') GROUP BY feature, part),
nb AS (SELECT feature, count(*) AS n_bins FROM bins GROUP BY feature),
rep AS (SELECT psi.feature, 0.0 AS missing_rate_current, psi.psi,
        CASE WHEN psi >= 0.25 THEN 'alert' WHEN psi >= 0.1 THEN 'warn' ELSE 'ok' END AS status FROM psi)"""


def _profile(spark, sf):
    s = scored(spark, sf)
    return s, M.reference_profile(s.filter(F.col("split") == "train"), FEATURE_COLUMNS)


@register("reference_profile", O.with_scored(
    f"""SELECT bins.feature, CAST(bins.bin AS BIGINT) AS bin,
        {R4("CASE WHEN bins.bin = 0 THEN CAST('-inf' AS DOUBLE) ELSE ed.edges[bins.bin] END")} AS lo,
        {R4("CASE WHEN bins.bin = len(ed.edges) THEN CAST('inf' AS DOUBLE) ELSE ed.edges[bins.bin + 1] END")} AS hi,
        CAST(coalesce(refc.c, 0) AS BIGINT) AS count, nb.n_bins, {R4('st.missing_rate')} AS missing_rate, st.n_rows,
        {R4('st.mean')} AS mean, {R4('st.p50')} AS p50, {R4('st.p90')} AS p90, {R4('st.p99')} AS p99
      FROM bins JOIN ed USING (feature) JOIN nb USING (feature) JOIN st ON st.feature = bins.feature AND st.part = 'reference'
      LEFT JOIN refc ON refc.feature = bins.feature AND refc.bin = bins.bin""", _drift_sql()))
def q_profile(spark, sf):
    return _profile(spark, sf)[1]


@register("drift_report", O.with_scored("SELECT rep.feature, " + R4("missing_rate_current") + " AS missing_rate_current, "
                                        + R4("psi") + " AS psi, status, n_bins, "
                                        + ", ".join(f"{w[0]}.n_rows AS n_rows_{w}, " + ", ".join(
                                            f"{R4(f'{w[0]}.{c}')} AS {c}_{w}" for c in ("mean", "p50", "p90", "p99"))
                                            for w in ("reference", "current"))
                                        + " FROM rep JOIN nb USING (feature)"
                                        " JOIN st r ON r.feature = rep.feature AND r.part = 'reference'"
                                        " JOIN st c ON c.feature = rep.feature AND c.part = 'current'", _drift_sql()))
def q_drift(spark, sf):
    s, prof = _profile(spark, sf)
    return M.drift_report(prof, s, FEATURE_COLUMNS)


@register("drift_summary", O.with_scored(
    "SELECT CAST(count(*) FILTER (WHERE status = 'ok') AS BIGINT) AS n_ok, "
    "CAST(count(*) FILTER (WHERE status = 'warn') AS BIGINT) AS n_warn, "
    "CAST(count(*) FILTER (WHERE status = 'alert') AS BIGINT) AS n_alert, CAST(0 AS BIGINT) AS n_missing_ref, "
    f"arg_max(feature, psi) AS top_alert_feature, {R4('max(psi)')} AS top_psi, "
    "CASE WHEN count(*) FILTER (WHERE status = 'alert') > 0 THEN 'alert' "
    "WHEN count(*) FILTER (WHERE status = 'warn') > 0 THEN 'warn' ELSE 'ok' END AS overall_status, "
    "CAST(count(*) FILTER (WHERE status = 'alert') > 0 AS BIGINT) AS has_alerts, "
    "CAST(count(*) FILTER (WHERE status = 'warn') > 0 AS BIGINT) AS has_warnings FROM rep", _drift_sql()))
def q_drift_summary(spark, sf):
    s, prof = _profile(spark, sf)
    return M.drift_summary(M.drift_report(prof, s, FEATURE_COLUMNS))


@register("top_psi_features", O.with_scored(
    f"SELECT feature, {R4('missing_rate_current')} AS missing_rate_current, {R4('psi')} AS psi, status "
    "FROM rep WHERE psi IS NOT NULL ORDER BY rep.psi DESC, feature LIMIT 5", _drift_sql()))
def q_top_psi(spark, sf):
    """The five features that moved most (O-66)."""
    s, prof = _profile(spark, sf)
    top = M.top_psi_features(M.drift_report(prof, s, FEATURE_COLUMNS), 5)
    return top.select("feature", "missing_rate_current", "psi", "status")


@register("alert_lists", O.with_scored(
    "SELECT coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE status = 'alert'), '') AS alert_features, "
    "coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE status = 'warn'), '') AS warn_features FROM rep",
    _drift_sql()))
def q_alert_lists(spark, sf):
    s, prof = _profile(spark, sf)
    lists = M.alert_lists(M.drift_report(prof, s, FEATURE_COLUMNS))
    return lists.select(*[F.array_join(c, ",").alias(c) for c in lists.columns])


@register("champion_vs_runner_up", O.with_scored(
    f"SELECT max(CASE WHEN k = 1 THEN policy END) AS champion, max(CASE WHEN k = 2 THEN policy END) AS runner_up, "
    f"{R4('max(CASE WHEN k = 1 THEN v END)')} AS champion_value, {R4('max(CASE WHEN k = 2 THEN v END)')} AS runner_up_value, "
    f"{R4('max(CASE WHEN k = 1 THEN v END) - max(CASE WHEN k = 2 THEN v END)')} AS gap "
    "FROM (SELECT policy, round(net_benefit_at_k, 2) AS v, "
    "row_number() OVER (ORDER BY round(net_benefit_at_k, 2) DESC, policy) AS k "
    "FROM pm WHERE split = 'test' AND budget_k = 0.1)", _long_sql()))
def q_champion_pair(spark, sf):
    """The two best rankings by test net benefit at 10 % (O-100)."""
    s = scored(spark, sf).filter(F.col("split") == "test")
    rows = EV.policy_metrics(s, [0.10], POLICIES, include_random=False)
    return C.champion_vs_runner_up(rows.select(
        F.col("policy").alias("model"), F.round("net_benefit_at_k", 2).alias("test_net_benefit_at_k")))


@register("calibration_holdout", O.with_scored(
    f"SELECT part, count(*) AS n_rows, {O.month('min(invoice_month)')} AS first_month, "
    f"{O.month('max(invoice_month)')} AS last_month FROM (SELECT sc.invoice_month, "
    "CASE WHEN m.i >= CAST(floor(m.n * 0.8) AS BIGINT) THEN 'calibrate' ELSE 'fit' END AS part "
    "FROM sc JOIN (SELECT invoice_month, row_number() OVER (ORDER BY invoice_month) - 1 AS i, count(*) OVER () AS n "
    "FROM (SELECT DISTINCT invoice_month FROM sc WHERE split = 'train')) m USING (invoice_month) "
    "WHERE split = 'train') GROUP BY part"))
def q_holdout(spark, sf):
    """Training months kept for calibration (O-50)."""
    fit, cal, _ = calibration_holdout(scored(spark, sf).filter(F.col("split") == "train"))
    parts = fit.withColumn("part", F.lit("fit")).unionByName(cal.withColumn("part", F.lit("calibrate")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), F.min("invoice_month").alias("first_month"),
                                     F.max("invoice_month").alias("last_month"))


@register("score_stats", O.with_scored(
    f"SELECT {R4('avg(CASE WHEN churn_prob IS NULL THEN 1.0 ELSE 0.0 END)')} AS missing_rate, "
    f"{R4('avg(churn_prob)')} AS mean, {R4('quantile_cont(churn_prob, 0.5)')} AS p50, "
    f"{R4('quantile_cont(churn_prob, 0.9)')} AS p90, {R4('quantile_cont(churn_prob, 0.99)')} AS p99 FROM sc"))
def q_score_stats(spark, sf):
    return M.score_stats(scored(spark, sf))


@register("psi_trend", O.with_scored(
    f"""SELECT {O.month('month')} AS month, top_feature, {R4('top_psi')} AS top_psi,
        {R4('previous_top_psi')} AS previous_top_psi, {R4('top_psi - previous_top_psi')} AS psi_change
      FROM (SELECT month, top_feature, top_psi, lag(top_psi) OVER (ORDER BY month) AS previous_top_psi
            FROM (SELECT month, arg_max(feature, psi) AS top_feature, max(psi) AS top_psi FROM mpsi GROUP BY month))""",
    _drift_sql(),
    f"""lm AS ({" UNION ALL ".join(f"SELECT invoice_month AS month, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM sc" for c in FEATURE_COLUMNS)}),
mc AS (SELECT lm.month, lm.feature, len(list_filter(ed.edges, lambda e: e <= lm.value)) AS bin, count(*) AS c
       FROM lm JOIN ed USING (feature) WHERE value IS NOT NULL GROUP BY 1, 2, 3),
mb AS (SELECT p.month, p.feature, unnest(range(0, len(ed.edges) + 1)) AS bin
       FROM (SELECT DISTINCT month, feature FROM mc) p JOIN ed USING (feature)),
mj AS (SELECT mb.month, mb.feature, mb.bin, coalesce(refc.c, 0) + 1e-8 AS e, coalesce(mc.c, 0) + 1e-8 AS a
       FROM mb LEFT JOIN mc USING (month, feature, bin) LEFT JOIN refc USING (feature, bin)),
mn AS (SELECT month, feature, e / sum(e) OVER (PARTITION BY month, feature) AS e,
              a / sum(a) OVER (PARTITION BY month, feature) AS a FROM mj),
mpsi AS (SELECT month, feature, sum((a - e) * ln(a / e)) AS psi FROM mn GROUP BY month, feature)"""))
def q_psi_trend(spark, sf):
    s, prof = _profile(spark, sf)
    return M.psi_trend(M.monthly_psi(prof, s, FEATURE_COLUMNS))
