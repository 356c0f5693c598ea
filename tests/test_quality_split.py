"""Checks, temporal split, leakage-safe feature choice, request frames."""

from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from retentia.config import DecisionConfig, SplitConfig
from retentia.operators import quality as Q
from retentia.operators.grains import clean_transactions
from retentia.operators.split import (add_split, feature_columns, prepare_request_frame, prediction_output,
                                      temporal_split)
from retentia.schemas import FEATURE_COLUMNS


def test_require_columns(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError):
        Q.require_columns(df, ["a", "b"], "x")
    Q.require_columns(df, ["a"], "x")


def test_null_thresholds(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "a double")
    with pytest.raises(ValueError):
        Q.validate_null_thresholds(df, {"a": 0.0}, "x")
    Q.validate_null_thresholds(df, {"a": 0.5, "missing": 0.0}, "x")


def test_unique_keys(spark):
    df = spark.createDataFrame([(1, "2020-01"), (1, "2020-01")], "id bigint, month string")
    with pytest.raises(ValueError):
        Q.validate_unique_keys(df, ["id", "month"], "x")
    Q.validate_unique_keys(df.limit(1), ["id", "month"], "x")


def test_date_order_with_sequence(spark):
    df = spark.createDataFrame([(1, 1, datetime(2020, 1, 2)), (1, 2, datetime(2020, 1, 1))],
                               "CustomerID bigint, seq bigint, InvoiceDate timestamp_ntz")
    with pytest.raises(ValueError):
        Q.validate_date_order(df, "CustomerID", "InvoiceDate", "x", seq_col="seq")
    Q.validate_date_order(df, "CustomerID", "InvoiceDate", "x")  # no sequence: not observable


def test_temporal_split_boundaries(spark):
    months = [date(2010, m, 1) for m in range(1, 7)]
    df = spark.createDataFrame([(m, i) for i, m in enumerate(months)], "invoice_month date, x bigint")
    cfg = SplitConfig("2010-02", "2010-03", "2010-04", "2010-05", "2010-06")
    tr, va, te = temporal_split(df, cfg)
    assert [r.x for r in tr.collect()] == [0, 1]
    assert sorted(r.x for r in va.collect()) == [2, 3]
    assert sorted(r.x for r in te.collect()) == [4, 5]
    labels = {r.x: r.split for r in add_split(df, cfg).collect()}
    assert labels == {0: "train", 1: "train", 2: "val", 3: "val", 4: "test", 5: "test"}


def test_feature_columns_exclude_leakage(spark):
    cols = ["CustomerID bigint", "invoice_month date", "T timestamp_ntz", "churn_90d int",
            "has_future_purchase_90d boolean", "customer_value_90d double", "a double", "b double", "c double"]
    df = spark.createDataFrame([], ", ".join(cols))
    assert feature_columns(df) == ["a", "b", "c"]


def test_request_frame_rules(spark):
    df = spark.createDataFrame([tuple(1.0 for _ in FEATURE_COLUMNS)], ", ".join(f"{c} double" for c in FEATURE_COLUMNS))
    out = prepare_request_frame(df, FEATURE_COLUMNS)
    assert out.columns[:3] == ["CustomerID", "invoice_month", "T"] and out.first().CustomerID is None
    with pytest.raises(ValueError):
        prepare_request_frame(df.withColumn("churn_90d", F.lit(1)), FEATURE_COLUMNS)
    with pytest.raises(ValueError):
        prepare_request_frame(df.withColumn("extra", F.lit(1)), FEATURE_COLUMNS)
    with pytest.raises(ValueError):
        prepare_request_frame(df.drop("aov_90d"), FEATURE_COLUMNS)
    with pytest.raises(ValueError):
        prediction_output(df)


def test_clean_transactions_under_ansi(spark):
    raw = spark.createDataFrame(
        [("1", "A", "x", "3", "2010-12-01 08:26:00", "2.5", "13085.0", "UK"),
         ("2", "A", "x", "abc", "2010-12-01 08:26:00", "2.5", "13085.0", "UK"),   # text in Quantity
         ("3", "A", "x", "1", "not a date", "2.5", "13085.0", "UK"),             # bad date
         ("4", "A", "x", "1", "2010-12-01 08:26:00", "2.5", None, "UK"),          # null id
         ("5", "A", "x", "-2", "2010-12-02 09:00:00", "0", "12000", "UK")],        # return, zero price kept
        "Invoice string, StockCode string, Description string, Quantity string, InvoiceDate string, "
        "Price string, `Customer ID` string, Country string")
    out = clean_transactions(raw).orderBy("Invoice").collect()
    assert [r.Invoice for r in out] == ["1", "5"]
    assert out[0].CustomerID == 13085 and out[0].Revenue == 7.5
    assert out[1].Revenue == 0.0


def test_decision_config_validation():
    with pytest.raises(ValueError):
        DecisionConfig(assumed_success_rate=-0.1)
    cfg = DecisionConfig.from_dict({"intervention_cost": 15, "heterogeneity": {"enabled": True}})
    assert cfg.intervention_cost == 15.0 and cfg.heterogeneity.enabled
