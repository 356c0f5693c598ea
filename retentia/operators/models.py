"""Distributed model fitting, calibration and scoring with ``pyspark.ml``
(O-47..O-56, O-88..O-92), boosted families by ``boosting``. Fits are iterative treeAggregate jobs; nothing is
collected except fitted parameters and the list of months."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, ImputerModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LABEL
from ..session import cut_lineage
from . import boosting as B
from . import logistic as L

# The parameter set of the reference; those of the boosted families are in boosting.GROWTH.
LOGIT = dict(C=1.0, max_iter=1000, tol=1e-4)


def _imputed(cols: Sequence[str]) -> list[str]:
    return [f"{c}__imp" for c in cols]


def training_medians(train: DataFrame, feature_cols: Sequence[str]) -> dict[str, float]:
    state = L.blocks(train, feature_cols, F.lit(0), F.lit(0), train.count())
    try:
        found = L.window_medians(state, len(feature_cols), [0])[0][0]
    finally:
        state.unpersist()
    empty = [c for c, x in zip(feature_cols, found) if np.isnan(x)]
    if empty:
        raise ValueError(f"no training value in columns {empty}")
    return {c: float(x) for c, x in zip(feature_cols, found)}


def median_imputer(train: DataFrame, feature_cols: Sequence[str]) -> ImputerModel:
    """A fitted imputer that holds the exact medians of ``train``, found by counting in bounded memory. The
    library's estimator takes them from one row, as a column of one value has that value as its median."""
    found = training_medians(train, feature_cols)
    row = train.sparkSession.createDataFrame([tuple(found[c] for c in feature_cols)],
                                             ", ".join(f"`{c}` double" for c in feature_cols))
    return Imputer(strategy="median", inputCols=list(feature_cols), outputCols=_imputed(feature_cols)).fit(row)


def build_model(name: str, feature_cols: Sequence[str], train: DataFrame, n_train: int,
                params: dict | None = None, label: str = LABEL) -> Pipeline:
    """Pipeline per family: median impute -> assemble -> (scale) -> classifier. ``train``: the rows
    it will be fitted on, read for the medians."""
    p = dict(params or {})
    imp = median_imputer(train, feature_cols)
    asm = VectorAssembler(inputCols=_imputed(feature_cols), outputCol="_features_raw", handleInvalid="keep")
    if name == "logistic_regression":
        c = float(p.get("C", LOGIT["C"]))
        n = max(n_train, 2)
        # Reference objective: sum(loss) + ||w||^2 / (2C) on population-standardised
        # features. Spark's scaler divides by the sample std, i.e. features shrink
        # by k = sqrt((n-1)/n); with w = k * v the same minimiser is reached by
        # regParam = k^2 / (C n) = (n - 1) / (C n^2) (same scores, same contributions).
        reg = (n - 1) / (c * n * n)
        scaler = StandardScaler(inputCol="_features_raw", outputCol="_features", withMean=True, withStd=True)
        lr = LogisticRegression(featuresCol="_features", labelCol=label, maxIter=int(p.get("max_iter", 1000)),
                                tol=float(p.get("tol", LOGIT["tol"])),
                                regParam=reg, elasticNetParam=0.0,
                                standardization=False, probabilityCol="_probability",
                                rawPredictionCol="_raw", predictionCol="_prediction")
        return Pipeline(stages=[imp, asm, scaler, lr])
    if name == "random_forest":
        rf = RandomForestClassifier(featuresCol="_features_raw", labelCol=label,
                                    numTrees=int(p.get("n_estimators", 100)), maxDepth=int(p.get("max_depth", 6)),
                                    seed=42)
        rf.setProbabilityCol("_probability").setRawPredictionCol("_raw").setPredictionCol("_prediction")
        return Pipeline(stages=[imp, asm, rf])
    raise ValueError(f"no model family {name!r}")


@dataclass
class BoostedModel:
    """Trees in the place of a fitted pipeline, with the training medians that stand for nulls elsewhere."""
    booster: B.Booster
    feature_cols: list[str]
    surrogates: list[float]


def boosted_model(name: str, feature_cols: Sequence[str], train: DataFrame, params: dict | None = None,
                  label: str = LABEL) -> BoostedModel:
    """A boosted family fitted on all rows of ``train``."""
    found = training_medians(train, feature_cols)
    booster = B.grow(train, [B.Booster(name, 0, B.growth(name, params))], feature_cols, F.lit(0), label)[0]
    return BoostedModel(booster, list(feature_cols), [found[c] for c in feature_cols])


def positive_probability(model: PipelineModel | BoostedModel, df: DataFrame, out_col: str) -> DataFrame:
    """P(class 1) clipped to [0, 1], with helper columns dropped."""
    if isinstance(model, BoostedModel):
        return B.score(df.drop(out_col), model.booster, model.feature_cols, out_col)
    scored = model.transform(df)
    p = vector_to_array(F.col("_probability"))[1]
    helper = [c for c in scored.columns if c.startswith("_") and c not in df.columns]
    helper += [c for c in scored.columns if c.endswith("__imp")]
    return scored.withColumn(out_col, F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))).drop(*helper)


@dataclass
class Calibrator:
    """Platt (logistic on the raw probability, unit L2 as in the reference) or
    isotonic (clipped outside the fitted range)."""
    method: str = "platt"
    a: float | None = None
    b: float | None = None
    iso: IsotonicRegressionModel | None = None

    def fit(self, scored: DataFrame, raw_col: str = "churn_prob_raw", label: str = LABEL) -> "Calibrator":
        m = self.method.strip().lower()
        if m not in ("platt", "isotonic"):
            raise ValueError(f"no calibration method {self.method!r}")
        stats = scored.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(label).alias("k")).first()
        if stats["k"] < 2:
            raise ValueError("calibration rows hold one label only")
        x = scored.select(F.array(F.col(raw_col)).alias("_a"), F.col(label).cast("double").alias("_y"))
        from pyspark.ml.functions import array_to_vector
        x = x.select(array_to_vector("_a").alias("_x"), "_y")
        if m == "platt":
            lr = LogisticRegression(featuresCol="_x", labelCol="_y", regParam=1.0 / stats["n"],
                                    standardization=False, maxIter=1000, tol=LOGIT["tol"])
            fit = lr.fit(x)
            self.a, self.b = float(fit.coefficients[0]), float(fit.intercept)
        else:
            self.iso = IsotonicRegression(featuresCol="_x", labelCol="_y", isotonic=True).fit(x)
        return self

    def column(self, raw: Column) -> Column:
        if self.method == "platt":
            z = F.lit(self.a) * raw + F.lit(self.b)
            return F.least(F.greatest(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), F.lit(0.0)), F.lit(1.0))
        raise ValueError("isotonic calibration is applied with transform()")

    def transform(self, df: DataFrame, raw_col: str = "churn_prob_raw", out_col: str = "churn_prob") -> DataFrame:
        if self.method == "platt":
            return df.withColumn(out_col, self.column(F.col(raw_col)))
        from pyspark.ml.functions import array_to_vector
        tmp = df.withColumn("_x", array_to_vector(F.array(F.col(raw_col))))
        out = self.iso.setFeaturesCol("_x").setPredictionCol("_iso").transform(tmp)
        return out.withColumn(out_col, F.least(F.greatest(F.col("_iso"), F.lit(0.0)), F.lit(1.0))).drop("_x", "_iso")


@dataclass
class TrainedModel:
    name: str
    model: PipelineModel | BoostedModel
    calibrator: Calibrator
    feature_cols: list[str]
    metadata: dict = field(default_factory=dict)

    def score(self, df: DataFrame) -> DataFrame:
        raw = positive_probability(self.model, df, "churn_prob_raw")
        return self.calibrator.transform(raw)


def calibration_holdout(train: DataFrame, label: str = LABEL, month_col: str = "invoice_month",
                        frac: float = 0.8):
    """Calibration rows (O-50): the last 20 % of train months (>= 3 months);
    else the last 20 % of rows in (month, customer) order; else all rows for
    both fit and calibration. Each candidate needs both classes."""
    months = sorted(r[0] for r in train.select(month_col).distinct().collect())  # one row per month
    if len(months) >= 3:
        cal_months = months[max(1, int(len(months) * frac)):]
        fit_part = train.filter(~F.col(month_col).isin(cal_months))
        cal_part = train.filter(F.col(month_col).isin(cal_months))
        if cal_part.agg(F.countDistinct(label)).first()[0] >= 2 and fit_part.limit(1).count() == 1:
            return fit_part, cal_part, cal_months
    from .rank import global_row_number
    ranked = global_row_number(train, [F.col(month_col), F.col("CustomerID")], "_pos", total_col="_n")
    split_at = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(frac)))
    fit_part = ranked.filter(F.col("_pos") <= split_at).drop("_pos", "_n")
    cal_part = ranked.filter(F.col("_pos") > split_at).drop("_pos", "_n")
    if cal_part.agg(F.countDistinct(label)).first()[0] >= 2 and fit_part.limit(1).count() == 1:
        return fit_part, cal_part, []
    return train, train, []


def train_and_score(name: str, train: DataFrame, to_score: DataFrame, feature_cols: Sequence[str],
                    params: dict | None = None, calibration_method: str = "platt",
                    label: str = LABEL) -> tuple[DataFrame, TrainedModel]:
    """Fit on the non-calibration part of train, calibrate on the held-out months,
    score ``to_score`` with raw and calibrated probabilities (O-50..O-54)."""
    fit_part, cal_part, cal_months = calibration_holdout(train, label)
    # iterative fits pass over the training rows many times: keep them cached
    # (a lost block is recomputed from the deterministic lineage)
    fit_part = fit_part.select(*feature_cols, label).persist()
    n = fit_part.count()
    if name in B.GROWTH:
        model = boosted_model(name, feature_cols, fit_part, params, label)
    else:
        model = build_model(name, feature_cols, fit_part, n, params, label).fit(fit_part)
    fit_part.unpersist()
    # read by several passes: scored once
    cal_scored = cut_lineage(positive_probability(model, cal_part, "churn_prob_raw").select("churn_prob_raw", label))
    cal = Calibrator(calibration_method).fit(cal_scored, "churn_prob_raw", label)
    tm = TrainedModel(name, model, cal, list(feature_cols),
                      {"method": calibration_method, "train_rows": n, "calibration_months": [str(m) for m in cal_months]})
    return tm.score(to_score), tm


def linear_coefficients(tm: TrainedModel) -> tuple[list[float], float, list[float], list[float]]:
    """(coef, intercept, scaler mean, scaler std) of a fitted logistic pipeline."""
    stages = tm.model.stages
    scaler, lr = stages[2], stages[3]
    return ([float(x) for x in lr.coefficients.toArray()], float(lr.intercept),
            [float(x) for x in scaler.mean.toArray()], [float(x) for x in scaler.std.toArray()])


def imputer_surrogates(tm: TrainedModel) -> list[float]:
    """The training medians that the fitted model puts in place of nulls."""
    if isinstance(tm.model, BoostedModel):
        return list(tm.model.surrogates)
    row = tm.model.stages[0].surrogateDF.first()
    return [float(row[c]) for c in tm.feature_cols]


def feature_importance(tm: TrainedModel, scored: DataFrame | None = None) -> DataFrame:
    """Linear: mean |scaled value x coef| over rows (or |coef| without rows);
    trees: the model's importances by gain. Sorted descending (O-56)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if tm.name == "logistic_regression":
        coef, _, mean, std = linear_coefficients(tm)
        if scored is not None:
            contrib = [F.avg(F.abs((F.coalesce(F.col(c).cast("double"), F.lit(x)) - F.lit(m))
                                   / F.lit(s if s else 1.0) * F.lit(w))).alias(c)
                       for c, w, m, s, x in zip(tm.feature_cols, coef, mean, std, imputer_surrogates(tm))]
            row = scored.agg(*contrib).first()
            vals = [(c, float(row[c] or 0.0)) for c in tm.feature_cols]
        else:
            vals = [(c, float(abs(w))) for c, w in zip(tm.feature_cols, coef)]
    elif isinstance(tm.model, BoostedModel):
        vals = [(c, float(v)) for c, v in zip(tm.feature_cols, tm.model.booster.gains())]
    else:
        imp = tm.model.stages[-1].featureImportances.toArray()
        vals = [(c, float(v)) for c, v in zip(tm.feature_cols, imp)]
    df = spark.createDataFrame(vals, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature")
