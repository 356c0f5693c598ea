"""Queries behind the reference's read endpoints and dashboards (O-25..O-27,
O-65, O-111..O-122), as functions returning DataFrames over published tables
(no server). Filters on partition columns prune files; limits are the feature."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.explain import explain_linear, explain_occlusion
from ..operators.split import prepare_request_frame
from ..schemas import ID_COLUMNS, PREDICTION_OUTPUT_COLUMNS
from ..sources import sinks as S


def lookup_prediction(preds: DataFrame, customer_id: int, invoice_month: str) -> DataFrame:
    """One saved customer-month (O-25); empty is an error for callers."""
    return (preds.filter((F.col("CustomerID") == F.lit(customer_id))
                         & (F.col("invoice_month") == F.to_date(F.lit(invoice_month + "-01"))))
                 .limit(1))


def explorer(preds: DataFrame, id_substring: str | None = None, targeted_only: bool = False,
             flag_col: str = "target_k10") -> DataFrame:
    """Substring filter on the customer id and targeted-only filter (O-26)."""
    out = preds
    if id_substring:
        out = out.filter(F.col("CustomerID").cast("string").contains(id_substring))
    if targeted_only:
        out = out.filter(F.col(flag_col) == 1)
    return out


def free_text_filter(df: DataFrame, query: str, sort_by: str | None = None, descending: bool = True,
                     limit: int | None = None) -> DataFrame:
    """Case-insensitive match of any column's text, optional sort and limit (O-27)."""
    blob = F.lower(F.concat_ws("\u0001", *[F.col(f"`{c}`").cast("string") for c in df.columns]))
    out = df.filter(blob.contains(query.lower())) if query else df
    if sort_by:
        out = out.orderBy(F.col(sort_by).desc() if descending else F.col(sort_by).asc())
    return out.limit(limit) if limit else out


def top_predictions(preds: DataFrame, sort_by: str = "policy_net_benefit", limit: int = 50,
                    total: bool = False) -> DataFrame:
    """Sorted predictions with a limit (O-65 / O-117); unknown column is an error. ``total``
    adds the number of rows before the limit as ``total_count``."""
    if sort_by not in preds.columns:
        raise ValueError(f"Unknown sort column: {sort_by}")
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be in [1, 1000]")
    top = preds.orderBy(F.col(sort_by).desc(), "CustomerID", "invoice_month").limit(limit)
    return top.withColumn("total_count", F.lit(preds.count()).cast("long")) if total else top


def kpis(preds: DataFrame) -> DataFrame:
    """Rows scored and mean probability of the slice (O-121)."""
    return preds.agg(F.count(F.lit(1)).alias("rows_scored"), F.avg("churn_prob").alias("mean_churn_prob"))


# ---------------------------------------------------------------- published-table views

def champion(spark: SparkSession, base: str) -> dict:
    return S.resolve_champion(spark, base)


def model_comparison(spark: SparkSession, base: str) -> DataFrame:
    return S.read_published(spark, base, "model_comparison", "train").orderBy(
        F.col("val_net_benefit_at_k").desc(), F.col("val_value_at_risk").desc())


def model_summary(spark: SparkSession, base: str) -> DataFrame:
    """One row (O-112): the newest training run's manifest, the promotion (``promoted_...``, null
    before any) and the comparison row of the manifest's champion."""
    run = S.latest_run(spark, base, "train")
    manifest = spark.read.json(S.table_path(base, "manifest_json", run)).withColumnRenamed("champion", "model")
    ch = champion(spark, base)
    promoted = [F.lit(ch.get(c)).cast(t).alias(n) for c, t, n in (
        ("model", "string", "promoted_model"), ("metric_name", "string", "promoted_metric"),
        ("metric_value", "double", "promoted_metric_value"), ("promoted_at", "string", "promoted_at"))]
    if ch["source"] != "promotion":
        promoted = [F.lit(None).cast(t).alias(n) for t, n in (
            ("string", "promoted_model"), ("string", "promoted_metric"), ("double", "promoted_metric_value"),
            ("string", "promoted_at"))]
    summary = manifest.select("*", *promoted, F.lit(ch["source"]).alias("champion_source"))
    compared = model_comparison(spark, base)
    return summary.join(compared.drop(*[c for c in compared.columns if c in summary.columns and c != "model"]),
                        "model", "left")


def feature_importance(spark: SparkSession, base: str, limit: int = 20) -> DataFrame:
    if not 1 <= limit <= 100:
        raise ValueError("limit must be in [1, 100]")
    return S.read_published(spark, base, "feature_importance", "train").orderBy(
        F.col("importance").desc()).limit(limit)


def policy_metrics(spark: SparkSession, base: str, model_name: str | None = None, split: str = "test") -> DataFrame:
    model_name = model_name or champion(spark, base)["model"]
    return S.read_published(spark, base, "policy_metrics", "train").filter(
        (F.col("model") == model_name) & (F.col("split") == split))


def decision_frontier(spark: SparkSession, base: str, model_name: str | None = None,
                      policy: str = "policy_net_benefit") -> DataFrame:
    return policy_metrics(spark, base, model_name, "test").filter(
        (F.col("policy") == policy) & (F.col("probability_type") == "calibrated"))


def targets(spark: SparkSession, base: str, budget_pct: int, limit: int = 100) -> DataFrame:
    """Partition-pruned target list (O-117)."""
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be in [1, 1000]")
    t = S.read_published(spark, base, "targets", "score").filter(F.col("budget_pct") == budget_pct)
    return t.orderBy(F.col("policy_net_benefit").desc(), "CustomerID", "invoice_month").limit(limit)


def predictions(spark: SparkSession, base: str, limit: int = 50, sort_by: str = "policy_net_benefit") -> DataFrame:
    return top_predictions(S.read_published(spark, base, "predictions", "score"), sort_by, limit).select(
        *PREDICTION_OUTPUT_COLUMNS)


def drift_latest(spark: SparkSession, base: str) -> DataFrame:
    return S.read_published(spark, base, "drift_report", "score")


def drift_history(spark: SparkSession, base: str, limit: int = 20) -> DataFrame | None:
    h = S.load_history(spark, base)
    return None if h is None else h.orderBy(F.col("generated_at_utc").desc()).limit(limit)


def decision_drift(spark: SparkSession, base: str, budget_pct: int | None = None) -> DataFrame:
    d = S.read_published(spark, base, "decision_drift", "score")
    if budget_pct is not None:
        d = d.filter(F.round(F.col("budget_k") * 100).cast("int") == budget_pct)
    return d


def backtest(spark: SparkSession, base: str, model_name: str | None = None,
             budget_pct: int | None = None) -> DataFrame:
    d = S.read_published(spark, base, "backtest_detail", "train")
    if model_name:
        d = d.filter(F.col("model") == model_name)
    if budget_pct is not None:
        d = d.filter(F.round(F.col("budget_k") * 100).cast("int") == budget_pct)
    return d


def segment_metrics(spark: SparkSession, base: str, segment_type: str | None = None,
                    split: str = "test") -> DataFrame:
    """The champion's segment evaluation of a split in the newest training run (O-115)."""
    rows = S.read_published(spark, base, "segment_metrics", "train").filter(F.col("split") == split)
    return rows.filter(F.col("segment_type") == segment_type) if segment_type else rows


def predict_requests(spark: SparkSession, base: str, requests: DataFrame) -> DataFrame:
    """Score a table of request rows with the champion: identifiers, raw and calibrated
    probability (O-22, O-118)."""
    tm = _champion_model(spark, base)
    frame = prepare_request_frame(requests, tm.feature_cols)
    return tm.score(frame).select(*ID_COLUMNS, "churn_prob_raw", "churn_prob")


def explain_requests(spark: SparkSession, base: str, requests: DataFrame, top_n: int = 3) -> DataFrame:
    """Explain request rows with the champion (O-118)."""
    tm = _champion_model(spark, base)
    frame = prepare_request_frame(requests, tm.feature_cols)
    if tm.name == "logistic_regression":
        return explain_linear(frame, tm, top_n)
    return explain_occlusion(frame, tm, ID_COLUMNS, top_n)


def _champion_model(spark: SparkSession, base: str):
    ch = champion(spark, base)
    return S.load_model(ch["model_path"] or S.newest_model(spark, base, ch["model"]))


def records(df: DataFrame) -> DataFrame:
    """Each row as one JSON record (O-120): dates and timestamps as ISO text, nulls kept,
    NaN and infinities as null."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("double", "float"):
            c = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        cols.append(c.alias(f.name))
    options = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    return df.select(F.to_json(F.struct(*cols), options).alias("record"))


def explain_saved_customer(spark: SparkSession, base: str, customer_id: int, invoice_month: str,
                           top_n: int = 3) -> DataFrame:
    """Saved prediction row + linear explanation of the champion (O-118); an
    empty lookup is an error."""
    if not 1 <= top_n <= 20:
        raise ValueError("top_n must be in [1, 20]")
    preds = S.read_published(spark, base, "predictions", "score")
    row = lookup_prediction(preds, customer_id, invoice_month)
    if row.limit(1).count() == 0:
        raise LookupError(f"No saved prediction for customer {customer_id} in {invoice_month}")
    tm = _champion_model(spark, base)
    if tm.name != "logistic_regression":
        return explain_occlusion(row, tm, ["CustomerID", "invoice_month"], top_n)
    return explain_linear(row, tm, top_n)


def simulate_policy(spark: SparkSession, base: str, budgets=None) -> DataFrame:
    """Policy what-if over the saved predictions, optional budgets (O-116)."""
    from ..config import BUDGETS
    from ..operators.compare import simulate_policy_by_budget
    return simulate_policy_by_budget(S.read_published(spark, base, "predictions", "score"), budgets or BUDGETS)


def simulate_experiment(spark: SparkSession, base: str, budgets=None) -> DataFrame:
    from ..config import BUDGETS, ExperimentConfig
    from ..operators.compare import simulate_experiment_by_budget
    return simulate_experiment_by_budget(S.read_published(spark, base, "predictions", "score"),
                                         budgets or BUDGETS, ExperimentConfig())


def load_predictions(spark: SparkSession, base: str, required=None) -> DataFrame:
    """Saved scored predictions, checking the required columns first (O-09)."""
    from ..operators.quality import require_columns
    preds = S.read_published(spark, base, "predictions", "score")
    require_columns(preds, list(required or PREDICTION_OUTPUT_COLUMNS), "saved predictions")
    return preds
