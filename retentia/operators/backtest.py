"""Expanding-window backtest (O-90..O-93)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .evaluate import classification_summary, policy_metrics
from .heuristics import add_policy_scores
from ..schemas import LABEL
from ..session import cut_lineage
from . import boosting as B
from . import logistic as L
from .models import LOGIT, train_and_score
from .rank import join_on_keys

SUMMARY_METRICS = ["value_at_risk", "net_benefit_at_k", "var_covered_frac", "precision_at_k",
                   "recall_at_k", "lift_at_k", "roc_auc", "pr_auc", "brier_score"]


def fold_table(features: DataFrame, min_train_months: int = 6, test_window_months: int = 2,
                step_months: int = 2) -> DataFrame:
    """Folds over *observed* months (positions, not calendar steps), as a small
    table: fold, train_end, test_start, test_end. The distinct months (one row
    per month) are collected and the folds laid out on the driver."""
    months = sorted(r[0] for r in features.select("invoice_month").distinct().collect())
    rows, i = [], min_train_months
    while i + test_window_months <= len(months):
        ts, te = months[i], months[i + test_window_months - 1]
        rows.append((f"{ts:%Y-%m}_{te:%Y-%m}", months[i - 1], ts, te))
        i += step_months
    return features.sparkSession.createDataFrame(
        rows, "fold string, train_end date, test_start date, test_end date")


Scorer = Callable[[str, DataFrame, DataFrame, Sequence[str], dict], DataFrame]


def fitted_scorer(name: str, train: DataFrame, test: DataFrame, feature_cols: Sequence[str],
                  params: dict) -> DataFrame:
    """Refit the family on the fold's training rows and score its test rows."""
    return train_and_score(name, train, test, feature_cols, params)[0]


def _month_number(column: str):
    return (F.year(column) * 12 + F.month(column)).cast("int")


def _number(day) -> int:
    return day.year * 12 + day.month


def _calibrated_folds(features: DataFrame, folds: Sequence, frac: float = 0.8) -> list[dict]:
    """The folds that ``calibration_holdout`` calibrates on the last months of the training window, which
    must hold both labels: the fold, its last month to fit on, its months to calibrate on, the rows up to them, and
    whether the months to fit on hold both labels and no row lacks one."""
    months = {r["m"]: r for r in features.select(_month_number("invoice_month").alias("m"), LABEL).groupBy("m").agg(
        F.min(LABEL).alias("low"), F.max(LABEL).alias("high"), F.count(F.lit(1)).alias("n"),
        F.count(LABEL).alias("labelled")).collect()}  # a row a month
    found = []

    def labels(own: Sequence[int]) -> set:
        return {x for m in own for x in (months[m]["low"], months[m]["high"]) if x is not None}

    for f in folds:
        train = sorted(m for m in months if m is not None and m <= _number(f["train_end"]))
        cut = max(1, int(len(train) * frac))
        if len(train) < 3 or len(labels(train[cut:])) < 2:
            continue
        whole = all(months[m]["n"] == months[m]["labelled"] for m in train)
        found.append({"fold": f, "last": train[cut - 1], "calibrate": (train[cut], train[-1]),
                      "rows": sum(months[m]["n"] for m in train),
                      "binary": whole and labels(train[:cut]) == labels(train) == {0, 1}})
    return found


def logistic_scores(features: DataFrame, calibrated: list[dict], params: dict, feature_cols: Sequence[str],
                    keep: Sequence[str], name: str = "logistic_regression") -> tuple[DataFrame | None, set[tuple[str, str]]]:
    """The logistic family refitted in every fold, all folds in the same passes: model, fold, ``keep``,
    churn_prob_raw and churn_prob of the test rows, and the (model, fold) pairs that it holds. Folds whose months
    to fit on hold one label are left to the caller."""
    own = sorted((c for c in calibrated if c["binary"]), key=lambda c: c["last"])
    if not own:
        return None, set()
    month, width, p = _month_number("invoice_month"), len(feature_cols), params or {}
    end = max(c["calibrate"][1] for c in own)
    state = L.blocks(features.filter(month <= end), feature_cols, month, F.col(LABEL), max(c["rows"] for c in own))
    try:
        fits, centre = L.fit_windows(state, width, [c["last"] for c in own], feature_cols, float(p.get("C", LOGIT["C"])),
                                     int(p.get("max_iter", LOGIT["max_iter"])), float(p.get("tol", LOGIT["tol"])))
        L.calibrate_windows(state, width, fits, [c["calibrate"] for c in own], centre, LOGIT["max_iter"], LOGIT["tol"])
    finally:
        state.unpersist()
    rows = [(m, name, c["fold"]["fold"], L.parameters(fit)) for c, fit in zip(own, fits, strict=True)
            for m in range(_number(c["fold"]["test_start"]), _number(c["fold"]["test_end"]) + 1)]
    known = features.sparkSession.createDataFrame(rows, f"_m int, model string, fold string, _p {L.PARAMETERS}")
    scored = (features.select(*dict.fromkeys([*keep, LABEL, *feature_cols]), month.alias("_m"))
              .join(F.broadcast(known), "_m")  # a row a tested month
              .withColumn("churn_prob_raw", L.probability("_p", feature_cols)))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("_p.a") * F.col("churn_prob_raw") + F.col("_p.b"))))
    return (scored.withColumn("churn_prob", p).select("model", "fold", *dict.fromkeys([*keep, LABEL]), "churn_prob_raw",
                                                      "churn_prob"), {(name, c["fold"]["fold"]) for c in own})


def boosted_scores(features: DataFrame, calibrated: list[dict], model_specs: dict[str, dict], feature_cols: Sequence[str],
                   keep: Sequence[str]) -> tuple[DataFrame | None, set[tuple[str, str]]]:
    """Boosted families refitted in every fold, all (fold, family) models grown at once: model, fold, ``keep``,
    churn_prob_raw and churn_prob of the test rows, and the (model, fold) pairs that it holds. Isotonic
    calibration is left to the caller."""
    models, windows, pairs = [], [], []
    for c in calibrated:
        f = c["fold"]
        for name, params in model_specs.items():
            if name in B.GROWTH and (params or {}).get("calibration_method", "platt") == "platt":
                models.append(B.Booster(name, c["last"], B.growth(name, params)))
                windows.append([(*c["calibrate"], "calibrate"), (_number(f["test_start"]), _number(f["test_end"]), "test")])
                pairs.append((name, f["fold"]))
    if not models:
        return None, set()
    models = B.grow(features, models, feature_cols, _month_number("invoice_month"))
    numbered = features.select(*dict.fromkeys([*keep, LABEL, *feature_cols]), _month_number("invoice_month").alias("_m"))
    scored = cut_lineage(B.score_windows(numbered, models, windows, feature_cols, "_m", list(dict.fromkeys([*keep, LABEL]))))
    fit = B.platt(scored.filter("use = 'calibrate'"), "k")
    names = features.sparkSession.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, model string, fold string")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("a") * F.col("churn_prob_raw") + F.col("b"))))
    known = fit.withColumnRenamed("g", "k").join(names, "k")  # a row a model
    tested = scored.filter("use = 'test'").join(F.broadcast(known), "k").withColumn("churn_prob", p)
    return tested.drop("k", "use", "a", "b"), set(pairs)


def run_backtest(spark: SparkSession, features: DataFrame, feature_cols: Sequence[str],
                 budgets: Sequence[float], model_specs: dict[str, dict],
                 parallel_fits: int = 8, observed_only: bool = False,
                 scorer: Scorer = fitted_scorer) -> tuple[DataFrame, DataFrame]:
    """Score every fold's test months with every model trained on the months before, then
    policy_ml rows and AUC / AP / Brier for each (model, fold) from one grouped pass.
    ``scorer`` refits per fold by default; the logistic and the boosted families are then fitted for all folds at
    once. ``observed_only`` drops right-censored rows (horizon past the data end)."""
    if observed_only:
        from .features import add_censoring_flag
        end = features.agg(F.max("T")).first()[0]
        features = add_censoring_flag(features, end).filter(F.col("label_observed")).drop("label_observed")
    folds = fold_table(features).collect()  # <= number of months
    keys = ["model", "fold", "train_end", "test_start", "test_end"]

    def one(f, name, params):
        train = features.filter(F.col("invoice_month") <= F.lit(f["train_end"]))
        test = features.filter((F.col("invoice_month") >= F.lit(f["test_start"]))
                               & (F.col("invoice_month") <= F.lit(f["test_end"])))
        # only policy_ml rows are reported, which need churn_prob and value_pos
        # alone, so the heuristic baselines are not computed per fold
        scored = add_policy_scores(scorer(name, train, test, feature_cols, params))
        return scored.select(
            F.lit(name).alias("model"), F.lit(f["fold"]).alias("fold"),
            *[F.lit(f[k]).alias(k) for k in keys[2:]],
            "CustomerID", "invoice_month", "churn_90d", "value_pos", "churn_prob", "policy_ml",
            "policy_net_benefit")

    together, held = [], set()
    if scorer is fitted_scorer and folds:
        calibrated, kept = _calibrated_folds(features, folds), ["CustomerID", "invoice_month", LABEL, "rev_sum_90d"]
        if "logistic_regression" in model_specs:
            made, pairs = logistic_scores(features, calibrated, model_specs["logistic_regression"], feature_cols, kept)
            together, held = [*together, made], held | pairs
        made, pairs = boosted_scores(features, calibrated, model_specs, feature_cols, kept)
        together, held = [*together, made], held | pairs
    # independent (fold, model) fits are submitted concurrently from a small
    # driver thread pool; each fit is itself a distributed job
    work = [(f, name, params) for f in folds for name, params in model_specs.items()
            if (name, f["fold"]) not in held]
    with ThreadPoolExecutor(max_workers=max(1, min(parallel_fits, len(work) or 1))) as pool:
        parts = list(pool.map(lambda w: one(*w), work))
    for made in (x for x in together if x is not None):
        spans = spark.createDataFrame([tuple(f[k] for k in ("fold", *keys[2:])) for f in folds],
                                      "fold string, train_end date, test_start date, test_end date")
        parts.append(add_policy_scores(made.join(F.broadcast(spans), "fold")).select(
            *keys, "CustomerID", "invoice_month", "churn_90d", "value_pos", "churn_prob", "policy_ml",
            "policy_net_benefit"))
    if not parts:
        schema = ("fold string, model string, train_end date, test_start date, test_end date, budget_k double, "
                  + ", ".join(f"{m} double" for m in SUMMARY_METRICS))
        empty = spark.createDataFrame([], schema)
        return empty, backtest_summary(empty)
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    scored = cut_lineage(scored)  # the scores of all folds, read by both metric passes
    detail = join_on_keys(
        policy_metrics(scored, budgets, ["policy_ml"], keys, include_random=False),
        classification_summary(scored, group_cols=keys), keys, "left", broadcast_right=True)
    detail = detail.select("fold", "model", *keys[2:], "budget_k", *SUMMARY_METRICS)
    return detail, backtest_summary(detail)


def backtest_summary(detail: DataFrame) -> DataFrame:
    """Mean and sample std per (model, budget) for the nine metrics (O-92)."""
    aggs = []
    for m in SUMMARY_METRICS:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std")]
    return detail.groupBy("model", "budget_k").agg(*aggs)


def backtest_stability(detail: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """Mean, population std and folds deviating by more than one std (O-93)."""
    per_fold = detail.groupBy("model", "fold").agg(F.avg(metric).alias("_v"))
    w = Window.partitionBy("model")  # one row per fold per model: tiny groups
    s = per_fold.withColumn("_mean", F.avg("_v").over(w)).withColumn("_std", F.stddev_pop("_v").over(w))
    return s.groupBy("model").agg(
        F.max("_mean").alias("mean"), F.max("_std").alias("std_pop"),
        F.count(F.lit(1)).alias("n_folds"),
        F.count_if(F.abs(F.col("_v") - F.col("_mean")) > F.col("_std")).alias("n_unstable_folds"))
