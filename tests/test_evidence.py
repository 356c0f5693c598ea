"""Evidence tables, statistics of profiles and drift reports, and the total beside a limit."""

import numpy as np
import pandas as pd
import pytest

from retentia.operators import monitor as M
from retentia.plans import evidence as E
from retentia.plans import tables as TB


def test_statistics_match_numpy_with_nulls(spark):
    rng = np.random.default_rng(5)
    x = [None if i % 10 == 0 else float(v) for i, v in enumerate(rng.normal(size=500))]
    df = spark.createDataFrame([(v, 2.0, None) for v in x], "x double, c double, e double")
    got = {r.feature: r for r in M.column_stats(df, ["x", "c", "e"]).collect()}
    seen = np.array([v for v in x if v is not None])
    r = got["x"]
    assert r.n_rows == 500 and r.missing_rate == pytest.approx(0.1) and r.mean == pytest.approx(seen.mean())
    assert (r.p50, r.p90, r.p99) == pytest.approx(tuple(np.quantile(seen, [0.5, 0.9, 0.99])))
    assert (got["c"].p50, got["c"].mean) == (2.0, 2.0)
    assert got["e"].missing_rate == 1.0 and got["e"].mean is None and got["e"].p90 is None


def test_report_carries_both_sides_and_reads_older_profiles(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    cur = spark.createDataFrame([(float(i + 5),) for i in range(50)], "x double")
    prof = M.reference_profile(ref, ["x"], n_bins=4)
    r = M.drift_report(prof, cur, ["x"]).first()
    assert (r.n_bins, r.n_rows_reference, r.n_rows_current) == (4, 100, 50)
    assert (r.p50_reference, r.p50_current, r.mean_current) == (49.5, 29.5, 29.5)
    old = prof.select("feature", "bin", "lo", "hi", "count", "missing_rate")
    r2 = M.drift_report(old, cur, ["x"]).first()
    assert r2.n_rows_reference is None and r2.mean_reference is None and r2.psi == pytest.approx(r.psi)


def test_score_statistics_of_both_sides(spark):
    ref = spark.createDataFrame([(i / 100.0,) for i in range(101)], "churn_prob double")
    cur = spark.createDataFrame([(0.5,), (None,)], "churn_prob double")
    prof = M.reference_profile(ref, ["churn_prob"])
    got = {r.part: r for r in M.score_statistics(prof, cur).collect()}
    assert (got["current"].n_rows, got["current"].missing_rate, got["current"].p90) == (2, 0.5, 0.5)
    assert got["reference"].n_rows == 101 and got["reference"].p90 == pytest.approx(0.9)
    none = M.score_statistics(prof.filter("feature = 'x'"), cur).collect()
    assert [r.part for r in none] == ["current"]


def test_evidence_builders(spark):
    frontier = spark.createDataFrame([(0.05, 1.0), (0.1, 2.0), (0.29, 3.0)], "budget_k double, net_benefit_at_k double")
    rows = E.budget_tradeoff_evidence(frontier, 29).collect()  # 0.29 * 100 is below 29 in doubles
    assert [r.budget_k for r in rows if r.is_selected] == [0.29] and {r.evidence_rows for r in rows} == {3}
    assert not any(r.is_selected for r in E.budget_tradeoff_evidence(frontier, 50).collect())
    rec = E.recommendation_evidence(frontier, "logistic_regression", 5).first()
    assert (rec.selected_budget, rec.selected_model) == (5, "logistic_regression")
    drift = spark.createDataFrame([(1,), (2,)], "x int")
    risk = E.risk_evidence(frontier, drift, drift.limit(0), 10).first()
    assert (risk.decision_drift_rows, risk.backtest_rows) == (2, 0)
    chart = E.chart_evidence(drift, "decision_drift").collect()
    assert len(chart) == 2 and chart[0].evidence_rows == 2 and not chart[0].is_selected
    with pytest.raises(ValueError):
        E.chart_evidence(drift, "pie")
    seg = spark.createDataFrame([("test", "value", "high", 1), ("val", "value", "high", 2), ("test", "value", None, 3)],
                                "split string, segment_type string, segment_value string, n int")
    assert [r.n for r in E.segment_evidence(seg, "value", "high").collect()] == [1]
    assert [r.n for r in E.segment_evidence(seg, "value", None).collect()] == [3]
    assert E.segment_evidence(seg, "value", "low").count() == 0


def test_policy_evidence_is_one_row(spark):
    pdf = pd.DataFrame({"CustomerID": range(40), "invoice_month": pd.Timestamp("2020-01-01").date(),
                        "policy_ml": [float(i) for i in range(40)], "policy_net_benefit": [float(-i) for i in range(40)],
                        "value_pos": 1.0, "churn_90d": [i % 2 for i in range(40)], "churn_prob": 0.5,
                        "expected_retained_value": 1.0, "expected_cost": 0.5, "assumed_success_rate_customer": 0.1,
                        "intervention_cost_customer": 0.5})
    rows = E.policy_evidence(spark.createDataFrame(pdf), 10).collect()
    assert len(rows) == 1 and rows[0].selected_budget == 10


def test_total_beside_the_limit(spark):
    df = spark.createDataFrame([(i, i, float(i)) for i in range(30)],
                               "CustomerID long, invoice_month int, policy_net_benefit double")
    top = TB.top_predictions(df, limit=3, total=True).collect()
    assert [r.CustomerID for r in top] == [29, 28, 27] and {r.total_count for r in top} == {30}
