"""Temporal split and model-feature selection (O-18, O-19, O-21, O-22, O-23)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SplitConfig
from ..schemas import (ID_COLUMNS, MODEL_DENY_COLUMNS, PREDICTION_OUTPUT_COLUMNS,
                       TRAINING_ONLY_COLUMNS, is_numeric)


def _month(s: str):
    return F.to_date(F.lit(s + "-01"))


def add_split(df: DataFrame, cfg: SplitConfig, month_col: str = "invoice_month") -> DataFrame:
    """One ``split`` column (train / val / test / null for unused months)."""
    m = F.col(month_col)
    return df.withColumn(
        "split",
        F.when(m <= _month(cfg.train_end), "train")
         .when((m >= _month(cfg.val_start)) & (m <= _month(cfg.val_end)), "val")
         .when((m >= _month(cfg.test_start)) & (m <= _month(cfg.test_end)), "test"))


def temporal_split(df: DataFrame, cfg: SplitConfig, month_col: str = "invoice_month"):
    """(train, val, test) frames; plain month filters so partition pruning applies."""
    m = F.col(month_col)
    train = df.filter(m <= _month(cfg.train_end))
    val = df.filter((m >= _month(cfg.val_start)) & (m <= _month(cfg.val_end)))
    test = df.filter((m >= _month(cfg.test_start)) & (m <= _month(cfg.test_end)))
    return train, val, test


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns not in the leakage / derived-score deny list (O-19)."""
    return [f.name for f in df.schema.fields
            if f.name not in MODEL_DENY_COLUMNS and is_numeric(f.dataType)]


def prediction_output(df: DataFrame) -> DataFrame:
    missing = [c for c in PREDICTION_OUTPUT_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"predictions lack columns {missing}")
    return df.select(*PREDICTION_OUTPUT_COLUMNS)


def prepare_request_frame(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Scoring request: reject training-only, unknown and missing columns; add
    missing identifier columns as nulls (O-22)."""
    cols = set(df.columns)
    training_only = sorted(cols & set(TRAINING_ONLY_COLUMNS))
    if training_only:
        raise ValueError(f"a request may not hold training columns: {training_only}")
    extra = sorted(cols - set(feature_cols) - set(ID_COLUMNS))
    if extra:
        raise ValueError(f"a request holds unknown columns: {extra}")
    missing = [c for c in feature_cols if c not in cols]
    if missing:
        raise ValueError(f"a request lacks model inputs: {missing}")
    types = {"CustomerID": "bigint", "invoice_month": "date", "T": "timestamp_ntz"}
    ids = [F.col(c) if c in cols else F.lit(None).cast(types[c]).alias(c) for c in ID_COLUMNS]
    return df.select(*ids, *feature_cols)


def with_probability_alias(df: DataFrame, prob_col: str) -> DataFrame:
    if prob_col not in df.columns:
        raise ValueError(f"no probability column {prob_col}")
    return df.withColumn("churn_prob", F.col(prob_col).cast("double"))


def inference_contract(feature_cols: list[str]) -> dict:
    """Model input / output contract saved next to every model (O-20)."""
    return {"inference_input_columns": list(feature_cols), "inference_id_columns": list(ID_COLUMNS),
            "training_only_columns": list(TRAINING_ONLY_COLUMNS),
            "prediction_output_columns": list(PREDICTION_OUTPUT_COLUMNS)}
