"""Decision metrics, top-k sizing and what-if simulations on small frames with answers
derived by hand."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from retentia.config import ExperimentConfig
from retentia.functions.columns import top_n
from retentia.operators import compare as C
from retentia.operators import evaluate as EV

MONTH = pd.Timestamp("2010-01-01").date()


def _frame(spark):
    pdf = pd.DataFrame({
        "CustomerID": [11, 12, 13, 14, 15], "invoice_month": [MONTH] * 5,
        "churn_90d": [0, 1, 1, 0, 1], "value_pos": [40.0, 300.0, 120.0, 75.0, 15.0],
        "policy_ml": [3.0, 9.0, 1.0, 7.0, 5.0], "policy_net_benefit": [-4.0, 30.0, 12.0, 8.0, 1.5],
        "churn_prob": [0.15, 0.65, 0.30, 0.55, 0.80]})
    return spark.createDataFrame(pdf)


def test_policy_metrics_by_hand(spark):
    m = EV.policy_metrics(_frame(spark), [0.4]).toPandas().set_index("policy")
    ml = m.loc["policy_ml"]  # two of five: customers 12 (churns) and 14 (stays)
    assert (ml.value_at_risk, ml.total_value_at_risk, ml.net_benefit_at_k) == (300.0, 435.0, 38.0)
    assert (ml.targeted_count, ml.captured_churners, ml.precision_at_k) == (2, 1, 0.5)
    assert ml.recall_at_k == pytest.approx(1 / 3) and ml.lift_at_k == pytest.approx(0.5 / 0.6)
    assert "policy_random" in m.index


def test_classification_by_hand(spark):
    c = EV.classification_summary(_frame(spark)).first()
    # positives .65 .30 .80 against negatives .15 .55: five of six pairs in order
    assert c.roc_auc == pytest.approx(5 / 6)
    # thresholds .80, .65 and .30 add a third of recall each, at precision 1, 1 and 3/4
    assert c.pr_auc == pytest.approx((1 + 1 + 0.75) / 3)
    assert c.brier_score == pytest.approx((0.0225 + 0.1225 + 0.49 + 0.3025 + 0.04) / 5)


@pytest.mark.parametrize("k,expected", [(0.05, 1), (0.15, 2), (0.25, 2), (0.5, 5)])
def test_top_n_half_even_minimum_one(spark, k, expected):
    n = spark.range(1).select(top_n(F.lit(10), k).alias("n")).first().n
    assert n == expected == max(1, int(round(10 * k)))


def test_top_n_matches_python_rounding(spark):
    cases = [(n, k) for n in (1, 7, 10, 13, 139, 278, 2779) for k in (0.05, 0.1, 0.15, 0.2, 0.25, 0.35, 1 / 3)]
    df = spark.createDataFrame(cases, "n long, k double")
    got = df.select("n", "k", top_n(F.col("n"), F.col("k")).alias("t")).collect()
    for r in got:
        assert r.t == max(1, int(round(r.n * r.k))), (r.n, r.k)


def test_experiment_arms(spark):
    pdf = pd.DataFrame({"CustomerID": [21, 22, 23, 24, 25, 26], "invoice_month": [MONTH] * 6,
                        "policy_net_benefit": [9.0, 7.0, 6.0, 5.0, 2.0, 1.0],
                        "churn_prob": [0.5, 0.25, 0.9, 0.1, 0.3, 0.6],
                        "value_pos": [40.0, 200.0, 10.0, 90.0, 5.0, 7.0],
                        "assumed_success_rate_customer": [0.4, 0.1, 0.3, 0.2, 0.5, 0.05],
                        "expected_retained_value": [8.0, 5.0, 2.7, 1.8, 0.75, 0.21]})
    r = C.simulate_experiment_by_budget(spark.createDataFrame(pdf), [0.67], ExperimentConfig()).first()
    assert r.assumption_driven is True
    assert (r.targeted_customers, r.treatment_customers, r.control_customers) == (4, 2, 2)
    assert r.incremental_retained_value == pytest.approx(0.5 * 0.4 * 40.0 + 0.25 * 0.1 * 200.0)
    assert r.top_treated_customer_ids.startswith("21") and r.top_control_customer_ids.startswith("23")


def test_experiment_config_validation():
    with pytest.raises(ValueError):
        ExperimentConfig(treatment_allocation_rate=1.0)
    with pytest.raises(ValueError):
        ExperimentConfig(treatment_effect_multiplier=-1.0)


def test_policy_comparison_no_change_under_flat_economics(spark):
    ml = [44.0, 31.5, 12.25, 6.0, 0.5]
    pdf = pd.DataFrame({"CustomerID": range(31, 36), "invoice_month": [MONTH] * 5,
                        "policy_ml": ml, "policy_net_benefit": [0.3 * x - 2.0 for x in ml],
                        "value_pos": [90.0, 70.0, 45.0, 20.0, 5.0], "churn_90d": [0, 1, 0, 1, 1]})
    r = C.simulate_policy_by_budget(spark.createDataFrame(pdf), [0.5]).first()
    assert r.assumption_driven is True
    assert r.ranking_changed is False and r.selected_customers_differ is False
    assert r.n_customers_rank_changed == 0


def test_segment_bands_right_closed(spark):
    pdf = pd.DataFrame({"rev_sum_90d": [50.0, 50.01, 200.0, 200.01, None],
                        "gap_days_prev": [30.0, 31.0, 90.0, 91.0, 1.0],
                        "freq_90d": [2.0, 3.0, 5.0, 6.0, 0.0]})
    s = EV.add_segment_columns(spark.createDataFrame(pdf)).toPandas()
    assert s.segment_value_band.tolist()[:4] == ["low_value", "mid_value", "mid_value", "high_value"]
    assert s.segment_value_band.isna().tolist()[4]  # null input -> null segment (own group)
    assert s.segment_recency_bucket.tolist()[:4] == ["recent", "warming", "warming", "stale"]
    assert s.segment_frequency_bucket.tolist()[:4] == ["low_frequency", "mid_frequency", "mid_frequency",
                                                       "high_frequency"]


def test_segment_evaluation_skips_small_and_single_class(spark):
    rows = []
    for i in range(12):
        rows.append((i, MONTH, float(300 + i), 100.0, 3.0, i % 2, 300.0 + i, 0.5, 10.0 + i))
    for i in range(12, 15):  # 3 rows in the low band: skipped (< 5)
        rows.append((i, MONTH, 10.0, 10.0, 1.0, 1, 10.0, 0.5, 1.0))
    pdf = pd.DataFrame(rows, columns=["CustomerID", "invoice_month", "rev_sum_90d", "gap_days_prev", "freq_90d",
                                      "churn_90d", "value_pos", "churn_prob", "policy_net_benefit"])
    seg = EV.evaluate_segments(spark.createDataFrame(pdf), [0.1]).toPandas()
    assert "low_value" not in set(seg.segment_value)
    assert "high_value" in set(seg.segment_value)
