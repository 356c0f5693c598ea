"""The three batch jobs: build features, train, score (section 3 of the survey).

Each job reads its inputs once, writes under a fresh run id and publishes last."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BUDGETS, PROJECT_DECISION, AlertConfig, DecisionConfig, SplitConfig
from ..operators import evaluate as EV
from ..operators import features as FE
from ..operators import grains as G
from ..operators import monitor as M
from ..operators import quality as Q
from ..operators.backtest import run_backtest
from ..operators.heuristics import add_heuristics, add_policy_scores
from ..operators.models import feature_importance, train_and_score
from ..operators.selection import TIE, target_flags, target_lists
from ..operators.split import add_split, feature_columns, prediction_output
from ..schemas import FEATURE_COLUMNS, TARGET_LIST_COLUMNS
from ..session import cut_lineage
from ..sources import sinks as S


def build_features_job(spark: SparkSession, tx: DataFrame, base: str, run_id: str | None = None,
                       horizon_days: int = 90) -> str:
    """Clean -> invoices (written, then re-read: the feature plan's two uses of it
    start from files, not from a second evaluation of the raw join) -> events,
    customer-month, features. Returns the run id."""
    run_id = run_id or S.new_run_id()
    Q.require_columns(tx, ["Invoice", "InvoiceDate", "Quantity", "Price"], "raw_transactions")
    clean = G.clean_transactions(tx)
    S.write_table(clean, base, "transactions_clean", run_id)
    clean = spark.read.parquet(S.table_path(base, "transactions_clean", run_id))
    Q.validate_null_thresholds(clean, {"InvoiceDate": 0.0, "CustomerID": 0.0, "Quantity": 0.0, "Price": 0.0},
                               "transactions_clean")
    S.write_table(G.invoice_rollup(clean), base, "invoices", run_id)
    inv = spark.read.parquet(S.table_path(base, "invoices", run_id))
    Q.validate_unique_keys(inv, ["Invoice", "CustomerID"], "invoice_df")
    S.write_table(G.customer_events(inv), base, "customer_events", run_id)
    S.write_table(G.customer_month(inv), base, "customer_month", run_id, ["invoice_month"], ["CustomerID"])
    ft = FE.feature_table(inv, horizon_days)
    S.write_table(ft, base, "feature_table", run_id, ["invoice_month"], ["CustomerID"])
    ft = spark.read.parquet(S.table_path(base, "feature_table", run_id))
    Q.validate_unique_keys(ft, ["CustomerID", "invoice_month"], "feature_table")
    Q.validate_null_thresholds(ft, {"CustomerID": 0.0, "invoice_month": 0.0, "T": 0.0, "churn_90d": 0.0},
                               "feature_table")
    S.publish_run(spark, base, run_id, "build_features",
                  ["transactions_clean", "invoices", "customer_events", "customer_month", "feature_table"])
    return run_id


def train_job(spark: SparkSession, base: str, split: SplitConfig | None = None,
              decision: DecisionConfig = PROJECT_DECISION, budgets: Sequence[float] = BUDGETS,
              model_specs: dict[str, dict] | None = None, backtest: bool = True,
              run_id: str | None = None) -> str:
    run_id = run_id or S.new_run_id()
    split = split or SplitConfig()
    specs = model_specs or {"logistic_regression": {}, "xgboost": {}, "lightgbm": {}}
    ft = S.read_published(spark, base, "feature_table", "build_features")
    ft = add_split(ft, split).filter(F.col("split").isNotNull())
    parts = {s: add_heuristics(ft.filter(F.col("split") == s)) for s in ("train", "val", "test")}
    cols = feature_columns(parts["train"].drop("split"))
    policy_rows, cls_rows, curve_rows = [], [], []
    models, paths = {}, {}
    for name, params in specs.items():
        to_score = parts["train"].unionByName(parts["val"]).unionByName(parts["test"])
        scored, tm = train_and_score(name, parts["train"], to_score, cols, params)
        models[name] = tm
        # scored once, then read by every metric and curve of both probability types
        S.write_table(scored, base, f"scored_{name}", run_id)
        scored = spark.read.parquet(S.table_path(base, f"scored_{name}", run_id))
        for ptype, pcol in (("calibrated", "churn_prob"), ("raw", "churn_prob_raw")):
            pol = add_policy_scores(scored.withColumn("churn_prob", F.col(pcol)), decision)
            pm = EV.policy_metrics(pol, budgets, group_cols=["split"])
            policy_rows.append(pm.withColumn("model", F.lit(name)).withColumn("probability_type", F.lit(ptype)))
            cl = EV.classification_summary(pol, group_cols=["split"])
            cls_rows.append(cl.withColumn("model", F.lit(name)).withColumn("probability_type", F.lit(ptype)))
            curve_rows.append(EV.curve_tables(pol, ["split"]).withColumn("model", F.lit(name))
                              .withColumn("probability_type", F.lit(ptype)))
        paths[name] = S.save_model(tm, base, run_id)
    S.write_table(_union(policy_rows), base, "policy_metrics", run_id)
    S.write_table(_union(cls_rows), base, "classification_metrics", run_id)
    S.write_table(_union(curve_rows), base, "curves", run_id)
    policy = spark.read.parquet(S.table_path(base, "policy_metrics", run_id))
    cls = spark.read.parquet(S.table_path(base, "classification_metrics", run_id))
    chosen = 0.10 if 0.10 in budgets else float(budgets[0])
    wide = (comparison_table(policy, cls, decision.targeting_policy, chosen)
            .withColumn("selection_policy", F.lit(decision.targeting_policy))
            .withColumn("calibration_method", F.lit(models[next(iter(models))].metadata["method"]))
            .withColumn("chosen_budget", F.lit(chosen)).withColumn("run_id", F.lit(run_id)))
    S.write_table(wide, base, "model_comparison", run_id)
    S.write_report_csv(wide, base, "model_comparison", run_id)
    champ = wide.orderBy(F.col("val_net_benefit_at_k").desc(), F.col("val_value_at_risk").desc(), "model").first()
    best = champ["model"]
    scored = add_policy_scores(spark.read.parquet(S.table_path(base, f"scored_{best}", run_id)), decision)
    segments = [EV.evaluate_segments(scored.filter(F.col("split") == part), budgets, decision.targeting_policy)
                .withColumn("split", F.lit(part)) for part in ("val", "test")]
    S.write_table(_union(segments), base, "segment_metrics", run_id)
    # drift reference: champion's train split with its scores
    S.write_table(M.reference_profile(scored.filter(F.col("split") == "train"),
                                      [*FEATURE_COLUMNS, "churn_prob"]), base, "reference_profile", run_id)
    S.write_table(feature_importance(models[best], parts["train"]), base, "feature_importance", run_id)
    tables = ["policy_metrics", "classification_metrics", "curves", "model_comparison", "segment_metrics",
              "reference_profile", "feature_importance", *[f"scored_{name}" for name in specs]]
    if backtest:
        detail, summary = run_backtest(spark, ft.drop("split"), cols, budgets, specs)
        S.write_table(detail, base, "backtest_detail", run_id)
        S.write_table(summary, base, "backtest_summary", run_id)
        tables += ["backtest_detail", "backtest_summary"]
    manifest = spark.createDataFrame(
        [(run_id, best, paths[best], ",".join(specs), ",".join(cols), ",".join(tables))],
        "run_id string, champion string, model_path string, models string, features string, tables string")
    S.write_report_json(manifest, base, "manifest", run_id)
    S.publish_run(spark, base, run_id, "train", tables)
    # what outlives a run points at it only once it is published: a job that dies
    # before leaves readers on the run before
    S.append_history(S.run_log(policy, run_id, ["model", "split", "policy", "probability_type"],
                               ["value_at_risk", "net_benefit_at_k", "precision_at_k", "recall_at_k", "lift_at_k"],
                               "budget_k"), base, run_id, "run_log")
    S.write_promotion(spark, base, best, paths[best], "val_net_benefit_at_k", champ["val_net_benefit_at_k"] or 0.0)
    return run_id


COMPARED = ("value_at_risk", "net_benefit_at_k", "roc_auc", "pr_auc", "brier_score", "precision_at_k",
            "recall_at_k", "lift_at_k", "var_covered_frac")


def comparison_table(policy: DataFrame, cls: DataFrame, targeting_policy: str, budget: float) -> DataFrame:
    """One row a model: validation and test metrics of the calibrated scores at the budget,
    and of the raw scores as ``..._raw`` (O-87, O-88)."""
    rows = (policy.filter((F.col("policy") == targeting_policy) & (F.col("budget_k") == budget))
            .join(cls, ["model", "split", "probability_type"]))
    return rows.groupBy("model").agg(*[
        F.max(F.when((F.col("split") == s) & (F.col("probability_type") == p), F.col(m)))
        .alias(f"{s}_{m}" + ("_raw" if p == "raw" else ""))
        for s in ("val", "test") for p in ("calibrated", "raw") for m in COMPARED])


def _union(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def score_job(spark: SparkSession, base: str, decision: DecisionConfig = PROJECT_DECISION,
              budgets: Sequence[float] = BUDGETS, alerts: AlertConfig | None = None,
              run_id: str | None = None, as_of_month: str | None = None) -> str:
    """Score the whole feature table with the champion (the reference ranks all
    months together); ``as_of_month='YYYY-MM'`` scores only that snapshot (a
    partition-pruned read). Flags, target lists, decision drift, feature drift,
    history row; publish."""
    from ..sources.sinks import load_model, resolve_champion
    run_id = run_id or S.new_run_id()
    ft = S.read_published(spark, base, "feature_table", "build_features")
    if as_of_month:
        ft = ft.filter(F.col("invoice_month") == F.to_date(F.lit(as_of_month + "-01")))
    champ = resolve_champion(spark, base)
    # nothing promoted yet: the default family's newest model
    tm = load_model(champ["model_path"] or S.newest_model(spark, base, champ["model"]))
    Q.validate_inference_frame(ft, tm.feature_cols)
    scored = add_policy_scores(tm.score(add_heuristics(ft)), decision)
    # the selection's passes read the policy and its tie-breaks, written once
    keys = cut_lineage(scored.select(decision.targeting_policy, *TIE))
    scored = target_flags(scored, decision.targeting_policy, budgets, written=keys)
    S.write_table(scored, base, "predictions", run_id, ["invoice_month"], ["CustomerID"])
    scored = spark.read.parquet(S.table_path(base, "predictions", run_id))
    S.write_table(prediction_output(scored), base, "predictions_inference", run_id)
    targets = (target_lists(scored, budgets)
               .withColumn("budget_pct", F.round(F.col("budget_k") * 100).cast("int"))
               .select(*TARGET_LIST_COLUMNS, "budget_pct"))
    S.write_table(targets, base, "targets", run_id, ["budget_pct"], ["CustomerID", "invoice_month"])
    S.write_table(M.decision_drift(scored, budgets, decision.targeting_policy), base, "decision_drift", run_id)
    tables = ["predictions", "predictions_inference", "targets", "decision_drift"]
    try:
        prof = S.read_published(spark, base, "reference_profile", "train")
    except FileNotFoundError:  # no training run yet: no drift report
        prof = None
    if prof is not None:
        rep = M.drift_report(prof, scored, FEATURE_COLUMNS, alerts)
        S.write_table(rep, base, "drift_report", run_id)
        S.write_table(M.score_statistics(prof, scored), base, "score_statistics", run_id)
        tables += ["drift_report", "score_statistics"]
    S.publish_run(spark, base, run_id, "score", tables)
    if prof is not None:
        S.append_history(M.drift_history_row(rep, scored, datetime.now(timezone.utc).isoformat()), base, run_id)
    return run_id
