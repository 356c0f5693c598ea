"""Model fitting, calibration and explanations (invariants)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retentia.operators.explain import explain_linear, explain_occlusion
from retentia.operators.models import Calibrator, feature_importance, train_and_score
from retentia.schemas import FEATURE_COLUMNS


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(240):
        x = rng.normal(size=len(FEATURE_COLUMNS))
        y = int(x[0] + 0.5 * x[8] + rng.normal(scale=0.5) > 0)
        rows.append((i, pd.Timestamp(2020, 1 + i % 6, 1).date(), y, *map(float, x)))
    cols = ["CustomerID", "invoice_month", "churn_90d", *FEATURE_COLUMNS]
    return spark.createDataFrame(pd.DataFrame(rows, columns=cols))


def test_logistic_contributions_sum_to_logit(spark, training):
    scored, tm = train_and_score("logistic_regression", training, training, FEATURE_COLUMNS)
    ex = explain_linear(scored, tm, top_n=2).toPandas()
    sums = ex.contributions.apply(lambda a: sum(s["contribution"] for s in a))
    np.testing.assert_allclose(ex.base_value + sums, ex.logit, atol=1e-9)
    assert ex.top_positive.apply(len).max() <= 2
    p = scored.toPandas()
    assert p.churn_prob.between(0, 1).all() and p.churn_prob_raw.between(0, 1).all()
    imp = feature_importance(tm, scored).toPandas()
    assert len(imp) == len(FEATURE_COLUMNS) and imp.importance.is_monotonic_decreasing


def test_platt_is_monotone_and_isotonic_clipped(spark, training):
    scored, tm = train_and_score("logistic_regression", training, training, FEATURE_COLUMNS)
    p = scored.select("churn_prob_raw", "churn_prob").toPandas().sort_values("churn_prob_raw")
    assert (np.diff(p.churn_prob.values) >= -1e-12).all() if tm.calibrator.a > 0 else True
    iso, _ = train_and_score("logistic_regression", training, training, FEATURE_COLUMNS,
                             calibration_method="isotonic")
    q = iso.toPandas()
    assert q.churn_prob.between(0, 1).all()
    with pytest.raises(ValueError):
        Calibrator("nope").fit(scored)


def test_tree_model_and_occlusion_shape(spark, training):
    scored, tm = train_and_score("lightgbm", training, training, FEATURE_COLUMNS, {"n_estimators": 5})
    ex = explain_occlusion(training.limit(20), tm, ["CustomerID", "invoice_month"], top_n=3).toPandas()
    assert len(ex) == 20
    assert ex.contributions.apply(len).eq(len(FEATURE_COLUMNS)).all()
    assert ex.contributions.apply(lambda a: any(abs(s["contribution"]) > 0 for s in a)).any()
    imp = feature_importance(tm).toPandas()
    assert len(imp) == len(FEATURE_COLUMNS)


def test_calibration_holdout_falls_back_to_row_order(spark, training):
    from retentia.operators.models import calibration_holdout
    two_months = training.withColumn("invoice_month", F.when(F.col("CustomerID") < 120, F.to_date(F.lit("2020-01-01")))
                                     .otherwise(F.to_date(F.lit("2020-02-01"))))
    fit, cal, months = calibration_holdout(two_months)
    assert months == [] and fit.count() == 192 and cal.count() == 48
    assert fit.join(cal, ["CustomerID", "invoice_month"]).count() == 0


def test_champion_vs_runner_up(spark):
    from retentia.operators.compare import champion_vs_runner_up
    cmp = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "model string, test_net_benefit_at_k double")
    r = champion_vs_runner_up(cmp).first()
    assert (r.champion, r.runner_up, r.gap) == ("b", "c", 1.0)


def _reference_logit(X, y, C=1.0, iters=50):
    """Newton's method for sum(logloss) + ||w||^2 / (2C) on population-standardised
    features with an unpenalised intercept (the reference's objective)."""
    mu, sd = X.mean(0), X.std(0)
    Z = np.hstack([np.ones((len(X), 1)), (X - mu) / sd])
    w = np.zeros(Z.shape[1])
    pen = np.eye(Z.shape[1]) / C
    pen[0, 0] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-Z @ w))
        g = Z.T @ (p - y) + pen @ w
        H = Z.T @ (Z * (p * (1 - p))[:, None]) + pen
        w -= np.linalg.solve(H, g)
    return 1 / (1 + np.exp(-Z @ w))


def test_logistic_matches_reference_objective(spark, training):
    from retentia.operators.models import build_model, positive_probability
    pdf = training.toPandas()
    n = len(pdf)
    model = build_model("logistic_regression", FEATURE_COLUMNS, training, n, {"tol": 1e-10}).fit(training)
    got = positive_probability(model, training, "p").toPandas().sort_values("CustomerID").p.values
    pdf = pdf.sort_values("CustomerID")
    exp = _reference_logit(pdf[FEATURE_COLUMNS].values, pdf.churn_90d.values.astype(float))
    np.testing.assert_allclose(got, exp, atol=1e-5)


def test_platt_matches_reference_objective(spark):
    rng = np.random.default_rng(5)
    raw = rng.random(400)
    y = (rng.random(400) < raw).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"churn_prob_raw": raw, "churn_90d": y.astype(int)}))
    cal = Calibrator("platt").fit(df)
    # reference: sum(logloss) + a^2 / 2 on the raw score, intercept unpenalised
    Z = np.column_stack([np.ones(400), raw])
    w = np.zeros(2)
    pen = np.diag([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-Z @ w))
        w -= np.linalg.solve(Z.T @ (Z * (p * (1 - p))[:, None]) + pen, Z.T @ (p - y) + pen @ w)
    assert cal.a == pytest.approx(w[1], abs=2e-3) and cal.b == pytest.approx(w[0], abs=2e-3)


def test_backtest_refits_every_family_in_every_fold(spark, training, monkeypatch):
    from retentia.plans import registry_models as RM

    # 12 months: folds start after month 6, 8 and 10
    rows = training.withColumn("invoice_month", F.add_months(F.lit("2020-01-01").cast("date"),
                                                             (F.col("CustomerID") % 12).cast("int")))
    monkeypatch.setattr(RM, "features", lambda spark, sf: rows)
    monkeypatch.setattr(RM, "SPECS", {"logistic_regression": {}, "xgboost": {"n_estimators": 2},
                                      "lightgbm": {"n_estimators": 2}})
    detail = RM._refitted(spark, None, tuple(RM.SPECS)).toPandas()
    assert set(zip(detail.model, detail.fold)) == {
        (m, f) for m in RM.SPECS for f in ("2020-07_2020-08", "2020-09_2020-10", "2020-11_2020-12")}
    # each fold's figures are those of a fit on its own training months
    train, test = rows.filter("invoice_month <= '2020-08-01'"), rows.filter(
        "invoice_month BETWEEN '2020-09-01' AND '2020-10-01'")
    scored = train_and_score("logistic_regression", train, test, FEATURE_COLUMNS, {})[0].toPandas()
    own = detail[(detail.model == "logistic_regression") & (detail.fold == "2020-09_2020-10")]
    brier = ((scored.churn_prob - scored.churn_90d) ** 2).mean()
    np.testing.assert_allclose(own.brier_score, brier, atol=1e-6)
    assert {"backtest_refit_logistic", "backtest_refit_detail", "backtest_refit_summary",
            "backtest_refit_stability"} <= set(RM.register.__globals__["QUERIES"])


def _same_as_library(spark, monkeypatch, rows):
    """Every fold's logistic scores against a fit of its own by the library."""
    from retentia.operators import backtest as BT

    folds = BT.fold_table(rows).collect()
    scored, held = BT.logistic_scores(rows, BT._calibrated_folds(rows, folds), {}, FEATURE_COLUMNS,
                                      ["CustomerID", "invoice_month"])
    assert held == {("logistic_regression", f["fold"]) for f in folds} and len(folds) >= 2
    got = scored.toPandas().set_index(["fold", "CustomerID", "invoice_month"]).sort_index()
    for f in folds:
        want = train_and_score("logistic_regression", rows.filter(F.col("invoice_month") <= F.lit(f["train_end"])),
                               rows.filter(F.col("invoice_month").between(f["test_start"], f["test_end"])),
                               FEATURE_COLUMNS, {})[0].toPandas().set_index(["CustomerID", "invoice_month"]).sort_index()
        own = got.loc[f["fold"]]
        for c in ("churn_prob_raw", "churn_prob"):
            np.testing.assert_allclose(own[c], want.loc[own.index, c], rtol=1e-7)


def test_logistic_folds_fitted_together_equal_single_fits(spark, training, monkeypatch):
    from retentia.operators import logistic as L

    monkeypatch.setattr(L, "PIVOTS", 8)  # several passes for a median
    monkeypatch.setattr(L, "CELL_PIVOTS", 2)
    monkeypatch.setattr(L, "CHUNK_ROWS", 7)
    first, second, third = FEATURE_COLUMNS[:3]
    rows = training.withColumn("invoice_month", F.add_months(F.lit("2020-01-01").cast("date"),
                                                             (F.col("CustomerID") % 10).cast("int")))
    odd = (rows.withColumn(first, F.when(F.col("CustomerID") % 7 != 0, F.col(first)))  # nulls and NaN: medians
           .withColumn(second, F.when(F.col("CustomerID") % 5 == 0, float("nan")).otherwise(F.col(second) * 1e6 + 3e6))
           .withColumn(third, F.lit(2.5)).repartition(3))
    _same_as_library(spark, monkeypatch, odd)


def test_backtest_fits_no_fold_on_its_own(spark, training, monkeypatch):
    from retentia.operators import backtest as BT

    rows = training.withColumn("invoice_month", F.add_months(F.lit("2020-01-01").cast("date"),
                                                             (F.col("CustomerID") % 12).cast("int")))

    def single(*a):
        raise AssertionError("a fold was fitted on its own")

    monkeypatch.setattr(BT, "train_and_score", single)
    detail, _ = BT.run_backtest(spark, rows, FEATURE_COLUMNS, (0.1,), {"logistic_regression": {},
                                                                        "lightgbm": {"n_estimators": 2}})
    assert detail.count() == 6


def test_a_fold_of_one_label_to_fit_on_is_left_to_single_fits(spark, training):
    from retentia.operators import backtest as BT

    rows = training.withColumn("invoice_month", F.add_months(F.lit("2020-01-01").cast("date"),
                                                             (F.col("CustomerID") % 8).cast("int")))
    early = rows.withColumn("churn_90d", F.when(F.month("invoice_month") <= 4, 0).otherwise(F.col("churn_90d")))
    calibrated = BT._calibrated_folds(early, BT.fold_table(early).collect())
    assert [c["binary"] for c in calibrated] == [False]
    assert BT.logistic_scores(early, calibrated, {}, FEATURE_COLUMNS, ["CustomerID"]) == (None, set())
    empty = rows.withColumn(FEATURE_COLUMNS[0], F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="no training value"):
        BT.logistic_scores(empty, BT._calibrated_folds(empty, BT.fold_table(empty).collect()), {}, FEATURE_COLUMNS,
                           ["CustomerID"])


def test_model_comparison_builds_its_rows_once(spark, training, monkeypatch):
    from retentia.plans import registry_models as RM

    rows = training.withColumn("invoice_month", F.add_months(F.lit("1999-08-01").cast("date"),
                                                             (F.col("CustomerID") % 14).cast("int")))
    built = []
    monkeypatch.setattr(RM, "features", lambda spark, sf: built.append(sf) or rows)
    monkeypatch.setattr(RM, "SPECS", {"logistic_regression": {}, "lightgbm": {"n_estimators": 2}})
    assert {r["model"] for r in RM.q_comparison(spark, "x").collect()} == set(RM.SPECS)
    assert built == ["x"]


def test_training_medians_need_no_exploded_rows(spark, training, monkeypatch):
    from retentia.operators import selection
    from retentia.operators.models import training_medians

    monkeypatch.setattr(selection, "_pass", None)  # would explode a row a value
    odd = training.withColumn("rev_sum_30d", F.when(F.col("CustomerID") % 3 != 0, F.col("rev_sum_30d")))
    want = odd.toPandas()[list(FEATURE_COLUMNS)].median()
    got = training_medians(odd, FEATURE_COLUMNS)
    assert got == {c: pytest.approx(want[c]) for c in FEATURE_COLUMNS}
