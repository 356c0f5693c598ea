"""Edge frames for the point-in-time features, checked against a brute-force
pandas implementation written from the definitions (left-open trailing frames,
forward (T, T+90d] frame, 999 first gap)."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retentia.operators.features import event_features, feature_table, label_at_points
from retentia.operators.grains import customer_events, customer_month, invoice_rollup

US = timedelta(microseconds=1)
T0 = datetime(2020, 6, 15, 12, 0, 0)


def _tx(spark, rows):
    pdf = pd.DataFrame(rows, columns=["Invoice", "CustomerID", "InvoiceDate", "Revenue"])
    pdf["Quantity"] = 1.0
    pdf["Price"] = pdf["Revenue"]
    return spark.createDataFrame(pdf).withColumn("InvoiceDate", F.col("InvoiceDate").cast("timestamp_ntz"))


def _brute(events: pd.DataFrame) -> pd.DataFrame:
    """events: CustomerID, InvoiceDate, event_revenue (event grain)."""
    out = []
    for (cid), g in events.groupby("CustomerID"):
        g = g.sort_values("InvoiceDate")
        for _, r in g.iterrows():
            t = r.InvoiceDate
            def win(days):
                return g[(g.InvoiceDate > t - timedelta(days=days)) & (g.InvoiceDate <= t)].event_revenue
            prev = g[g.InvoiceDate < t].InvoiceDate
            fut = g[(g.InvoiceDate > t) & (g.InvoiceDate <= t + timedelta(days=90))].event_revenue
            w90 = win(90)
            out.append(dict(CustomerID=cid, InvoiceDate=t, rev_sum_30d=win(30).sum(), rev_sum_90d=w90.sum(),
                            rev_sum_180d=win(180).sum(), freq_30d=float(len(win(30))), freq_90d=float(len(w90)),
                            rev_std_90d=(w90.std() if len(w90) > 1 else np.nan),
                            return_count_90d=float((w90 < 0).sum()), aov_90d=w90.mean(),
                            gap_days_prev=((t - prev.max()).total_seconds() / 86400 if len(prev) else 999.0),
                            has_future_purchase_90d=len(fut) > 0, customer_value_90d=fut.sum()))
    return pd.DataFrame(out)


ROWS = [
    # customer 1: boundary events around T0
    (1, 1, T0 - timedelta(days=180), 10.0),          # exactly 180 d before: out of the 180 d frame
    (2, 1, T0 - timedelta(days=180) + US, 11.0),     # 1 us inside
    (3, 1, T0 - timedelta(days=90), 12.0),           # exactly 90 d before
    (4, 1, T0 - timedelta(days=30), 13.0),           # exactly 30 d before
    (5, 1, T0 - timedelta(days=30) + US, -5.0),      # return, 1 us inside 30 d
    (6, 1, T0, 20.0),
    (7, 1, T0, 30.0),                                # same timestamp, second invoice: one event
    (8, 1, T0 + timedelta(days=90), 40.0),           # exactly at T+90 d: inside the horizon
    (9, 1, T0 + timedelta(days=90) + US, 50.0),      # 1 us after: outside
    # customer 2: single event
    (10, 2, T0, 5.0),
    # customer 3: next event is a return (still a purchase event for the label)
    (11, 3, T0, 7.0),
    (12, 3, T0 + timedelta(days=20), -7.0),          # next month
    # customer 4: gaps longer than the look-back halo, events across many buckets
    (13, 4, datetime(2015, 1, 1), 1.0),
    (14, 4, datetime(2016, 3, 1), 2.0),
    (16, 4, datetime(2019, 12, 31, 23, 59, 59), 4.0),
    (17, 4, datetime(2020, 1, 1), 5.0),
]


def test_event_features_match_brute_force(spark):
    inv = invoice_rollup(_tx(spark, ROWS))
    got = event_features(inv).toPandas().sort_values(["CustomerID", "InvoiceDate"]).reset_index(drop=True)
    ev = customer_events(inv).toPandas()
    exp = _brute(ev).sort_values(["CustomerID", "InvoiceDate"]).reset_index(drop=True)
    assert len(got) == len(exp)
    for c in ["rev_sum_30d", "rev_sum_90d", "rev_sum_180d", "freq_30d", "freq_90d", "rev_std_90d",
              "return_count_90d", "aov_90d", "gap_days_prev", "customer_value_90d"]:
        np.testing.assert_allclose(got[c].astype(float), exp[c].astype(float), rtol=1e-9, atol=1e-9,
                                   equal_nan=True, err_msg=c)
    assert got.has_future_purchase_90d.tolist() == exp.has_future_purchase_90d.tolist()


@pytest.mark.parametrize("bucket_days", [180, 360, 1000])
def test_bucket_width_does_not_change_results(spark, bucket_days):
    inv = invoice_rollup(_tx(spark, ROWS))
    a = feature_table(inv, bucket_days=bucket_days).toPandas().sort_values(["CustomerID", "invoice_month"])
    b = feature_table(inv, bucket_days=5000).toPandas().sort_values(["CustomerID", "invoice_month"])
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))


def test_feature_table_semantics(spark):
    inv = invoice_rollup(_tx(spark, ROWS))
    ft = feature_table(inv).toPandas().set_index(["CustomerID", "invoice_month"])
    r = ft.loc[(1, pd.Timestamp("2020-06-01").date())]
    assert r["rev_sum_30d"] == pytest.approx(-5.0 + 50.0)      # 30-d-old event excluded
    assert r["freq_30d"] == 2.0
    assert r["rev_sum_180d"] == pytest.approx(11 + 12 + 13 - 5 + 50)
    assert r["churn_90d"] == 0 and r["customer_value_90d"] == pytest.approx(40.0)
    single = ft.loc[(2, pd.Timestamp("2020-06-01").date())]
    assert single["rev_std_90d"] == 0.0 and single["gap_days_prev"] == 999.0 and single["churn_90d"] == 1
    ret = ft.loc[(3, pd.Timestamp("2020-06-01").date())]
    assert ret["churn_90d"] == 0  # a return still counts as a next purchase
    far = ft.loc[(4, pd.Timestamp("2016-03-01").date())]  # previous event older than the halo
    assert far["gap_days_prev"] == pytest.approx((datetime(2016, 3, 1) - datetime(2015, 1, 1)).days)
    dec = ft.loc[(4, pd.Timestamp("2019-12-01").date())]
    assert dec["gap_days_prev"] == pytest.approx((datetime(2019, 12, 31, 23, 59, 59) - datetime(2016, 3, 1)).total_seconds() / 86400)
    jan = ft.loc[(4, pd.Timestamp("2020-01-01").date())]
    assert jan["gap_days_prev"] == pytest.approx(1 / 86400)


def test_general_label_form_matches_fused(spark):
    inv = invoice_rollup(_tx(spark, ROWS))
    fused = feature_table(inv).select("CustomerID", "invoice_month", "churn_90d", "customer_value_90d").toPandas()
    general = label_at_points(customer_month(inv), customer_events(inv)).select(
        "CustomerID", "invoice_month", "churn_90d", "customer_value_90d").toPandas()
    key = ["CustomerID", "invoice_month"]
    m = fused.merge(general, on=key, suffixes=("_f", "_g"))
    assert len(m) == len(fused) == len(general)
    assert (m.churn_90d_f == m.churn_90d_g).all()
    np.testing.assert_allclose(m.customer_value_90d_f, m.customer_value_90d_g)


def test_features_ignore_future_rows(spark):
    """Perturbing rows after T must not change any trailing feature at T."""
    inv = invoice_rollup(_tx(spark, ROWS))
    inv2 = invoice_rollup(_tx(spark, [r if r[2] <= T0 else (r[0], r[1], r[2], r[3] * 100) for r in ROWS]))
    cols = ["rev_sum_30d", "rev_sum_90d", "rev_sum_180d", "freq_90d", "rev_std_90d", "aov_90d", "gap_days_prev"]
    a = feature_table(inv).filter("T <= '2020-06-15 12:00:00'").select("CustomerID", "T", *cols).toPandas()
    b = feature_table(inv2).filter("T <= '2020-06-15 12:00:00'").select("CustomerID", "T", *cols).toPandas()
    pd.testing.assert_frame_equal(a.sort_values(["CustomerID", "T"]).reset_index(drop=True),
                                  b.sort_values(["CustomerID", "T"]).reset_index(drop=True))


def test_hot_customer_is_split_across_window_partitions(spark):
    """One customer owns a third of all events (10 years, daily): the window
    partitions (customer, bucket) keep any single partition small."""
    rows = []
    inv_id = 0
    for d in range(3650):
        inv_id += 1
        rows.append((inv_id, 1, datetime(2010, 1, 1) + timedelta(days=d), 1.0))
    for c in range(2, 7302):
        inv_id += 1
        rows.append((inv_id, c, datetime(2015, 1, 1) + timedelta(days=c % 300), 2.0))
    tx = _tx(spark, rows)
    from retentia.operators.features import _bucketed
    inv = invoice_rollup(tx)
    parts = (_bucketed(inv, 360, 180, 90).groupBy("CustomerID", "_part").count()
             .agg(F.max("count").alias("mx"), F.sum("count").alias("tot")).first())
    assert parts.mx <= 0.06 * parts.tot  # hot customer: ~1/3 of rows, spread over ~11 buckets
    ft = feature_table(inv).filter("CustomerID = 1").count()
    assert ft == 120  # one row per month, 10 years


def test_censoring_flag(spark):
    inv = invoice_rollup(_tx(spark, ROWS))
    from retentia.operators.features import add_censoring_flag
    ft = feature_table(inv)
    end = ft.agg(F.max("T")).first()[0]
    flagged = add_censoring_flag(ft, end).toPandas()
    # rows whose 90-day horizon passes the data end are not observed
    exp = (flagged["T"] + pd.Timedelta(days=90)) <= pd.Timestamp(end)
    assert (flagged["label_observed"] == exp).all()
    assert not flagged.label_observed.all() and flagged.label_observed.any()
