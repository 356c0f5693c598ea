"""Row explanations (O-57a..c) as column expressions over the whole table.

Linear: contribution_i = standardised value_i x coef_i; base = intercept;
logit = base + sum(contributions); probability = sigmoid(logit) (uncalibrated,
as in the reference). Non-linear: occlusion -- each feature replaced by its
training median, rescored once per feature; the drop in probability is the
contribution (an approximation, not Shapley values; same output shape)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import occluded
from .models import BoostedModel, TrainedModel, imputer_surrogates, linear_coefficients, positive_probability


def _contrib_struct(names: Sequence[str], values: Sequence[Column]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("feature"), v.alias("contribution")) for n, v in zip(names, values)])


def _top(arr: Column, n: int, positive: bool) -> Column:
    kept = F.filter(arr, lambda s: s["contribution"] > 0 if positive else s["contribution"] < 0)
    if positive:
        ordered = F.array_sort(kept, lambda a, b: F.when(a["contribution"] > b["contribution"], -1)
                               .when(a["contribution"] < b["contribution"], 1).otherwise(0))
    else:
        ordered = F.array_sort(kept, lambda a, b: F.when(a["contribution"] < b["contribution"], -1)
                               .when(a["contribution"] > b["contribution"], 1).otherwise(0))
    return F.slice(ordered, 1, n)


def explain_linear(df: DataFrame, tm: TrainedModel, top_n: int = 3) -> DataFrame:
    coef, intercept, mean, std = linear_coefficients(tm)
    return explain_linear_params(df, tm.feature_cols, coef, intercept, mean, std, top_n,
                                 imputer_surrogates(tm))


def explain_linear_params(df: DataFrame, feature_cols: Sequence[str], coef: Sequence[float], intercept: float,
                          mean: Sequence[float], std: Sequence[float], top_n: int = 3,
                          fill: Sequence[float] | None = None) -> DataFrame:
    """Linear explanation for given standardisation and coefficients. A null takes its
    ``fill`` value (the model's imputer surrogate; the mean if none is given)."""
    if top_n < 1:
        raise ValueError("top_n must be >= 1")
    vals = [((F.coalesce(F.col(c).cast("double"), F.lit(x)) - F.lit(m)) / F.lit(s if s else 1.0)) * F.lit(w)
            for c, w, m, s, x in zip(feature_cols, coef, mean, std, fill or mean)]
    arr = _contrib_struct(feature_cols, vals)
    total = F.aggregate(arr, F.lit(0.0), lambda acc, s: acc + s["contribution"])
    return (df.withColumn("contributions", arr)
              .withColumn("base_value", F.lit(float(intercept)))
              .withColumn("logit", F.col("base_value") + total)
              .withColumn("explained_probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit"))))
              .withColumn("top_positive", _top(F.col("contributions"), top_n, True))
              .withColumn("top_negative", _top(F.col("contributions"), top_n, False)))


def explain_occlusion(df: DataFrame, tm: TrainedModel, key_cols: Sequence[str],
                      top_n: int = 3) -> DataFrame:
    """Every row is scored as it is and once with each feature at its training median
    (the model's imputer surrogate): one probability column a variant, no exploded rows."""
    if top_n < 1:
        raise ValueError("top_n must be >= 1")
    feats = tm.feature_cols
    if isinstance(tm.model, BoostedModel):
        out = occluded(df.select(*key_cols, *feats), tm.model.booster, feats, imputer_surrogates(tm),
                       ["explained_probability", *[f"_occ_{i}" for i in range(len(feats))]])
        return _occlusion(out, feats, key_cols, top_n)
    out = positive_probability(tm.model, df.select(*key_cols, *feats), "explained_probability")
    for i, (c, median) in enumerate(zip(feats, imputer_surrogates(tm))):
        variant = out.withColumn(f"_keep_{c}", F.col(c)).withColumn(c, F.lit(float(median)))
        out = (positive_probability(tm.model, variant, f"_occ_{i}")
               .withColumn(c, F.col(f"_keep_{c}")).drop(f"_keep_{c}"))
    return _occlusion(out, feats, key_cols, top_n)


def _occlusion(out: DataFrame, feats: Sequence[str], key_cols: Sequence[str], top_n: int) -> DataFrame:
    arr = _contrib_struct(feats, [F.col("explained_probability") - F.col(f"_occ_{i}")
                                  for i in range(len(feats))])
    return (out.select(*key_cols, "explained_probability", arr.alias("contributions"))
            .withColumn("top_positive", _top(F.col("contributions"), top_n, True))
            .withColumn("top_negative", _top(F.col("contributions"), top_n, False)))
