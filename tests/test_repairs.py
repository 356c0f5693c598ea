"""Baseline independence, month ends at short horizons, multi-file streams, null
imputation in explanations, scoring without a promotion, request tables."""

import datetime as dt
import json
import math
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_random_baseline_is_independent_of_customer_and_month(spark):
    from retentia.operators.evaluate import random_score
    grid = spark.range(400).select(
        (F.col("id") % 40 + 13000).alias("CustomerID"),
        F.add_months(F.lit(dt.date(2010, 1, 1)), (F.col("id") / 40).cast("int")).alias("invoice_month"))
    pdf = grid.withColumn("r", random_score()).toPandas()
    months = pd.to_datetime(pdf.invoice_month).astype("int64")
    for other in (pdf.CustomerID, months):
        assert abs(pdf.r.rank().corr(other.rank())) < 0.15
    assert pdf.r.nunique() == len(pdf)


@pytest.mark.parametrize("horizon", [7, 14, 30, 90])
def test_one_month_end_row_at_bucket_borders(spark, horizon):
    from retentia.operators.features import US_PER_DAY, feature_table
    # a bucket border (360 days from the epoch) inside the month, events on both sides of it
    border = dt.datetime(1970, 1, 1) + dt.timedelta(days=360 * 20)
    assert US_PER_DAY == 86_400_000_000
    times = [border + dt.timedelta(days=d) for d in (-9, -1, 8, 200)]
    rows = [(i, 1, t, 10.0, 1.0, 1) for i, t in enumerate(times)]
    inv = spark.createDataFrame(rows, "Invoice long, CustomerID long, InvoiceDate timestamp_ntz, "
                                "invoice_total_revenue double, invoice_total_quantity double, num_lines long")
    ft = feature_table(inv, horizon_days=horizon).toPandas()
    expected = pd.Series(times).groupby([pd.Series(times).dt.to_period("M")]).max()
    assert sorted(ft["T"]) == sorted(expected) and not ft.duplicated(["CustomerID", "invoice_month"]).any()


def test_stream_over_a_folder_of_files_counts_every_line_once(spark):
    from retentia.streaming.events import EVENT_SOURCE_SCHEMA, daily_event_rollup, purchase_stream, run_available
    base = tempfile.mkdtemp(prefix="retentia-stream-")
    day = dt.datetime(2011, 3, 5, 10)
    for i, late in enumerate((0, -40, 0, 3)):  # the second file is far older than the first
        rows = [(i, day + dt.timedelta(days=late), 7, "purchase", 1.0 + i, None),
                (i, day, 8, "view", 1.0, None)]
        spark.createDataFrame(rows, EVENT_SOURCE_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{base}/events.parquet")
    out = run_available(spark, daily_event_rollup(purchase_stream(spark, f"{base}/events.parquet"), None),
                        f"{base}/out", f"{base}/ck").collect()
    got = {r.day.start.date(): (r.event_revenue, r.n_events) for r in out}
    assert len(got) == len(out) == 3
    assert got[day.date()] == (4.0, 2)


def test_explanation_of_nulls_is_the_models_own_logit(spark):
    from retentia.operators.explain import explain_linear
    from retentia.operators.models import positive_probability, train_and_score
    rows = [(i, dt.date(2010, 1 + i % 9, 1), float(i % 7) ** 2, float(i % 5), int((i * 7) % 11 < 5))
            for i in range(200)]
    df = spark.createDataFrame(rows, "CustomerID long, invoice_month date, a double, b double, churn_90d int")
    _, tm = train_and_score("logistic_regression", df, df, ["a", "b"])
    probe = spark.createDataFrame([(1, None, 2.0), (2, 3.0, None)], "CustomerID long, a double, b double")
    want = {r.CustomerID: r.p for r in positive_probability(tm.model, probe, "p").collect()}
    for r in explain_linear(probe, tm).collect():
        assert math.isclose(r.explained_probability, want[r.CustomerID], abs_tol=1e-9)


def test_score_without_promotion_requests_and_segments(spark):
    from retentia.config import SplitConfig
    from retentia.plans import jobs, tables
    from retentia.schemas import FEATURE_COLUMNS
    from retentia.sources import sinks as S
    from retentia.sources.tables import transactions
    base = tempfile.mkdtemp(prefix="retentia-first-")
    jobs.build_features_job(spark, transactions(spark, SF_SMALL), base)
    with pytest.raises(FileNotFoundError):
        jobs.score_job(spark, base)
    run = jobs.train_job(spark, base, SplitConfig(), model_specs={"logistic_regression": {}}, backtest=False)
    cmp = tables.model_comparison(spark, base).first().asDict()
    assert {"val_roc_auc_raw", "test_net_benefit_at_k_raw", "selection_policy", "calibration_method"} <= set(cmp)
    assert tables.segment_metrics(spark, base).count() > 0
    assert {r.split for r in tables.segment_metrics(spark, base, split="val").collect()} == {"val"}
    summary = tables.model_summary(spark, base).collect()
    assert len(summary) == 1 and len(set(summary[0].asDict())) == len(summary[0])
    assert (summary[0].run_id, summary[0].model, summary[0].promoted_model) == (run, *["logistic_regression"] * 2)
    assert summary[0].promoted_metric_value == cmp["val_net_benefit_at_k"]
    manifest = spark.read.json(S.table_path(base, "manifest_json", run)).first()
    assert manifest.champion == "logistic_regression" and manifest.run_id == run
    os.rename(os.path.join(base, S.PROMOTIONS), os.path.join(base, "elsewhere"))
    jobs.score_job(spark, base)  # the newest model of the default family
    assert tables.champion(spark, base)["source"] == "default"
    ask = S.read_published(spark, base, "feature_table", "build_features").select(
        "CustomerID", *FEATURE_COLUMNS).limit(5)
    scored = tables.predict_requests(spark, base, ask).collect()
    assert len(scored) == 5 and all(0 <= r.churn_prob <= 1 and r.invoice_month is None for r in scored)
    assert tables.explain_requests(spark, base, ask).count() == 5
    record = json.loads(tables.records(ask.withColumn("x", F.lit(float("nan")))).first().record)
    assert record["x"] is None and "CustomerID" in record
