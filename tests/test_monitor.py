"""Drift: PSI invariants, bins cover every row, constant features, decision drift."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retentia.operators import monitor as M


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    n = 2000
    pdf = pd.DataFrame({"x": rng.normal(size=n), "y": rng.integers(0, 5, n).astype(float), "c": 1.0})
    return spark.createDataFrame(pdf), pdf


def test_profile_bins_cover_rows_and_match_numpy(spark, frame):
    df, pdf = frame
    prof = M.reference_profile(df, ["x", "y", "c"]).toPandas()
    for col in ["x", "y", "c"]:
        p = prof[prof.feature == col].sort_values("bin")
        assert p["count"].sum() == len(pdf)
        s = pdf[col].values
        edges = np.unique(np.quantile(s, np.linspace(0, 1, 11)))
        if len(edges) < 2:
            bins = [-np.inf, np.inf]
        else:
            bins = [-np.inf] + list(edges[1:-1]) + [np.inf]
        counts, _ = np.histogram(s, bins=bins)
        assert p["count"].tolist() == counts.tolist(), col
    assert len(prof[prof.feature == "c"]) == 1  # constant -> one bin


def test_psi_self_is_zero_and_shift_alerts(spark, frame):
    df, _ = frame
    prof = M.reference_profile(df, ["x", "y"])
    same = M.drift_report(prof, df, ["x", "y"]).toPandas()
    assert np.allclose(same.psi, 0.0) and set(same.status) == {"ok"}
    shifted = df.withColumn("x", F.col("x") + 3.0)
    rep = M.drift_report(prof, shifted, ["x", "y"]).toPandas().set_index("feature")
    assert rep.loc["x", "status"] == "alert" and rep.loc["y", "status"] == "ok"
    summ = M.drift_summary(M.drift_report(prof, shifted, ["x", "y"])).first()
    assert summ.overall_status == "alert" and summ.top_alert_feature == "x"


def test_missing_reference_feature(spark, frame):
    df, _ = frame
    prof = M.reference_profile(df, ["x"])
    rep = M.drift_report(prof, df, ["x", "y"]).toPandas().set_index("feature")
    assert rep.loc["y", "status"] == "no_reference" and pd.isna(rep.loc["y", "psi"])


def test_score_stats_match_numpy(spark, frame):
    df, pdf = frame
    s = M.score_stats(df, "x").first()
    assert s.mean == pytest.approx(pdf.x.mean())
    for name, q in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99)):
        assert getattr(s, name) == pytest.approx(np.quantile(pdf.x, q))


def test_monthly_psi_matches_whole_table_psi_for_one_month(spark, frame):
    df, _ = frame
    one = df.withColumn("invoice_month", F.to_date(F.lit("2020-01-01")))
    prof = M.reference_profile(df, ["x", "y"])
    whole = {r.feature: r.psi for r in M.psi_table(prof, one, ["x", "y"]).collect()}
    monthly = {r.feature: r.psi for r in M.monthly_psi(prof, one, ["x", "y"]).collect()}
    for f in ("x", "y"):
        assert monthly[f] == pytest.approx(whole[f], abs=1e-12)
    trend = M.psi_trend(M.monthly_psi(prof, one, ["x", "y"])).collect()
    assert len(trend) == 1 and trend[0].previous_top_psi is None


def test_profile_and_drift_read_the_rows_once(spark, monkeypatch):
    r = np.random.default_rng(11)
    ref = pd.DataFrame({"a": np.round(r.normal(size=800), 1), "b": r.integers(0, 3, 800).astype(float)})
    now = pd.DataFrame({"a": np.round(r.normal(0.5, 1, 600), 1), "b": r.integers(0, 4, 600).astype(float)})
    frames = [spark.createDataFrame(p).withColumn("a", F.when(F.col("b") < 3, F.col("a"))) for p in (ref, now)]
    calls, long = [], M._long
    monkeypatch.setattr(M, "_long", lambda df, cols: calls.append(1) or long(df, cols))
    profile = M.reference_profile(frames[0], ["a", "b"])
    assert len(calls) == 1
    got = {x.feature: x for x in M.drift_report(profile, frames[1], ["a", "b"]).collect()}
    assert len(calls) == 2
    now.loc[now.b >= 3, "a"] = np.nan
    for c in ("a", "b"):
        values = now[c].dropna()
        assert got[c].n_rows_current == 600
        assert got[c].missing_rate_current == pytest.approx(now[c].isna().mean())
        assert [got[c].mean_current, got[c].p50_current, got[c].p90_current, got[c].p99_current] == pytest.approx(
            [values.mean(), *np.quantile(values, [0.5, 0.9, 0.99])])
        u = np.unique(np.quantile(ref[c], np.linspace(0, 1, 11)))
        cuts = [-np.inf, *u[1:-1], np.inf]
        e, a = (np.histogram(v, cuts)[0] + 1e-8 for v in (ref[c], values))
        e, a = e / e.sum(), a / a.sum()
        assert got[c].psi == pytest.approx(((a - e) * np.log(a / e)).sum())
