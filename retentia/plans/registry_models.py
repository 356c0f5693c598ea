"""Registered model queries (fits are iterative, so most are rows-only checks;
their invariants are covered in tests/)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import BUDGETS, PROJECT_DECISION, SplitConfig
from ..operators import backtest as BT
from ..operators import boosting as BO
from ..operators import calibration as CA
from ..operators import evaluate as EV
from ..operators.explain import explain_linear, explain_linear_params, explain_occlusion
from ..operators.heuristics import add_heuristics, add_policy_scores
from ..operators.models import feature_importance, train_and_score
from ..operators.split import add_split, feature_columns
from ..schemas import FEATURE_COLUMNS
from ..session import cut_lineage, ensure_checkpoint_dir
from . import oracles as O
from . import registry_decisions as DEC
from .common import features
from .registry import KEYS, register

# The three families with the full parameter sets of operators.models.
SPECS = {"logistic_regression": {}, "xgboost": {}, "lightgbm": {}}


def _split_frames(spark: SparkSession, sf: str):
    """Whole feature table (every month is scored), and its train split."""
    ft = add_split(cut_lineage(features(spark, sf)), SplitConfig())
    ft = cut_lineage(add_heuristics(ft))  # read by every pass of the fits: joined once
    train = ft.filter(F.col("split") == "train")
    return ft, train, ft


def _fit(spark, sf, name, method="platt", frames=None):
    ft, train, rest = frames or _split_frames(spark, sf)
    cols = [c for c in feature_columns(ft.drop("split")) if c not in ("has_future_purchase_90d",)]
    scored, tm = train_and_score(name, train, rest, cols, SPECS.get(name), method)
    return scored, tm


@register("logistic_scores")
def q_logit(spark, sf):
    scored, _ = _fit(spark, sf, "logistic_regression")
    return scored.select(*KEYS, "split", "churn_prob_raw", "churn_prob")


@register("gbt_scores")
def q_gbt(spark, sf):
    scored, _ = _fit(spark, sf, "xgboost")
    return scored.select(*KEYS, "split", "churn_prob_raw", "churn_prob")


@register("isotonic_scores")
def q_iso(spark, sf):
    scored, _ = _fit(spark, sf, "logistic_regression", "isotonic")
    return scored.select(*KEYS, "split", "churn_prob_raw", "churn_prob")


@register("platt_parameters")
def q_platt(spark, sf):
    _, tm = _fit(spark, sf, "logistic_regression")
    return spark.createDataFrame([(tm.calibrator.a, tm.calibrator.b)], "a double, b double")


@register("model_comparison")
def q_comparison(spark, sf):
    """Per model: val/test decision and classification metrics at 10 %; champion
    by val net benefit, then val VaR (val-only tie-break, Q-18)."""
    rows, frames = None, _split_frames(spark, sf)

    def fitted(name):
        return cut_lineage(_fit(spark, sf, name, frames=frames)[0])  # read by both metric passes

    with ThreadPoolExecutor(max_workers=len(SPECS)) as pool:  # independent fits, each a distributed job
        made = list(pool.map(fitted, SPECS))
    for name, scored in zip(SPECS, made, strict=True):
        pol = add_policy_scores(scored, PROJECT_DECISION)
        pm = EV.policy_metrics(pol, [0.10], ["policy_net_benefit"], ["split"], include_random=False)
        cls = EV.classification_summary(pol, group_cols=["split"])
        j = pm.join(cls, "split").filter(F.col("split").isin("val", "test"))
        wide = j.groupBy().agg(*[F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}")
                                 for s in ("val", "test")
                                 for m in ("value_at_risk", "net_benefit_at_k", "roc_auc", "pr_auc", "brier_score")])
        wide = wide.withColumn("model", F.lit(name)).withColumn("chosen_budget", F.lit(0.10))
        rows = wide if rows is None else rows.unionByName(wide)
    from pyspark.sql import Window
    w = Window.orderBy(F.col("val_net_benefit_at_k").desc(), F.col("val_value_at_risk").desc(), "model")
    return rows.withColumn("rank", F.row_number().over(w)).withColumn("is_champion", F.col("rank") == 1)


@register("feature_importance")
def q_importance(spark, sf):
    scored, tm = _fit(spark, sf, "logistic_regression")
    return feature_importance(tm, scored)


@register("tree_feature_importance")
def q_importance_tree(spark, sf):
    _, tm = _fit(spark, sf, "lightgbm")
    return feature_importance(tm)


@register("linear_contributions")
def q_linear(spark, sf):
    scored, tm = _fit(spark, sf, "logistic_regression")
    ex = explain_linear(scored, tm, top_n=3)
    return ex.select(*KEYS, "base_value", "logit", "explained_probability",
                     F.to_json("top_positive").alias("top_positive"),
                     F.to_json("top_negative").alias("top_negative"))


@register("occlusion_contributions")
def q_occlusion(spark, sf):
    ft, train, rest = _split_frames(spark, sf)
    cols = [c for c in feature_columns(ft.drop("split"))]
    _, tm = train_and_score("lightgbm", train, rest, cols)
    ex = explain_occlusion(rest, tm, KEYS, top_n=3)
    return ex.select(*KEYS, "explained_probability", F.to_json("top_positive").alias("top_positive"),
                     F.to_json("top_negative").alias("top_negative"))


FOLDS_SQL = O.with_base(
    """SELECT strftime(ts, '%Y-%m') || '_' || strftime(te, '%Y-%m') AS fold, strftime(tr, '%Y-%m') AS train_end,
              strftime(ts, '%Y-%m') AS test_start, strftime(te, '%Y-%m') AS test_end
       FROM (SELECT a.invoice_month AS ts, p.invoice_month AS tr, e.invoice_month AS te
             FROM mi a JOIN mi p ON p.i = a.i - 1 JOIN mi e ON e.i = a.i + 1, (SELECT count(*) AS n FROM mi) c
             WHERE a.i >= 6 AND (a.i - 6) % 2 = 0 AND a.i + 2 <= c.n)""",
    "mi AS (SELECT invoice_month, row_number() OVER (ORDER BY invoice_month) - 1 AS i FROM (SELECT DISTINCT invoice_month FROM ft))")


@register("backtest_folds", FOLDS_SQL)
def q_folds(spark, sf):
    return BT.fold_table(features(spark, sf))


def _train_scaled(name, train, test, feature_cols, params):
    """A fold score that any engine can compute: revenue over ten times its training mean."""
    scale = train.agg(F.avg("rev_sum_90d")).first()[0] * 10.0
    return test.withColumn("churn_prob", F.least(F.greatest(
        F.col("rev_sum_90d") / F.lit(scale), F.lit(0.0)), F.lit(1.0)))


def _backtest(spark, sf):
    """The whole backtest over a fixed score per fold: folds, metrics and their summaries are
    SQL-checked. The ``backtest_refit_*`` queries refit the families in each fold."""
    ft = cut_lineage(features(spark, sf))  # read by every fold: built once
    return BT.run_backtest(spark, ft, feature_columns(ft), BUDGETS, {"train_scaled": {}},
                           scorer=_train_scaled)[0]


_FOLD_CTES = ("mi AS (SELECT invoice_month, row_number() OVER (ORDER BY invoice_month) - 1 AS i "
              "FROM (SELECT DISTINCT invoice_month FROM ft))", """fd AS (
  SELECT strftime(a.invoice_month, '%Y-%m') || '_' || strftime(e.invoice_month, '%Y-%m') AS fold,
         p.invoice_month AS tr, a.invoice_month AS ts, e.invoice_month AS te
  FROM mi a JOIN mi p ON p.i = a.i - 1 JOIN mi e ON e.i = a.i + 1, (SELECT count(*) AS n FROM mi) c
  WHERE a.i >= 6 AND (a.i - 6) % 2 = 0 AND a.i + 2 <= c.n)""", """scl AS (
  SELECT fold, avg(rev_sum_90d) * 10.0 AS scale FROM fd JOIN ft ON ft.invoice_month <= fd.tr GROUP BY fold)""",
              """sc AS (
  SELECT fd.fold, fd.tr, fd.ts, fd.te, ft.CustomerID, ft.invoice_month, ft.churn_90d,
         greatest(ft.rev_sum_90d, 0.0) AS value_pos,
         least(greatest(ft.rev_sum_90d / scl.scale, 0.0), 1.0) AS churn_prob,
         least(greatest(ft.rev_sum_90d / scl.scale, 0.0), 1.0) * greatest(ft.rev_sum_90d, 0.0) AS policy_ml,
         least(greatest(ft.rev_sum_90d / scl.scale, 0.0), 1.0) * greatest(ft.rev_sum_90d, 0.0) AS policy_net_benefit
  FROM fd JOIN scl USING (fold) JOIN ft ON ft.invoice_month BETWEEN fd.ts AND fd.te)""",
              DEC._long_sql("true", "fold", {"policy_ml": "policy_ml"}), DEC._cls_sql("true", "fold"), """cl AS (
  SELECT c.fold, roc_auc, pr_auc, brier_score FROM
    (SELECT fold, sum((cnt - pos) * ((tp - pos) + pos / 2.0)) / nullif(max(P) * max(N), 0) AS roc_auc,
            sum(pos * tp / pp) / nullif(max(P), 0) AS pr_auc FROM cum GROUP BY fold) c
    JOIN (SELECT fold, avg((churn_prob - churn_90d) * (churn_prob - churn_90d)) AS brier_score
          FROM sc GROUP BY fold) b ON c.fold = b.fold)""", """dt AS (
  SELECT pm.fold, 'train_scaled' AS model, fd.tr, fd.ts, fd.te, budget_k, value_at_risk, net_benefit_at_k,
         CASE WHEN total_value_at_risk > 0 THEN value_at_risk / total_value_at_risk ELSE 0.0 END AS var_covered_frac,
         captured_churners / targeted_count AS precision_at_k,
         CASE WHEN pos_ > 0 THEN captured_churners / pos_ ELSE 0.0 END AS recall_at_k,
         CASE WHEN pos_ > 0 THEN (captured_churners / targeted_count) / (pos_ / rows_) ELSE 0.0 END AS lift_at_k,
         roc_auc, pr_auc, brier_score
  FROM pm JOIN fd USING (fold) JOIN cl USING (fold))""")


def _bt_sql(select: str) -> str:
    return O.with_base(select, *_FOLD_CTES)


_M = BT.SUMMARY_METRICS


@register("backtest_detail", _bt_sql(
    f"SELECT fold, model, {O.month('tr')} AS train_end, {O.month('ts')} AS test_start, {O.month('te')} AS test_end, "
    f"{O.r4('budget_k')} AS budget_k, " + ", ".join(
        f"{O.r4(f'round({m}, 2)' if m in ('value_at_risk', 'net_benefit_at_k') else m)} AS {m}" for m in _M)
    + " FROM dt"))
def q_bt_detail(spark, sf):
    # sums of money in cents: two places, so that engines agree on halves
    return _backtest(spark, sf).withColumns(
        {c: F.round(c, 2) for c in ("value_at_risk", "net_benefit_at_k")})


@register("backtest_summary", _bt_sql(
    f"SELECT model, {O.r4('budget_k')} AS budget_k, " + ", ".join(
        f"{O.r4(f'avg({m})')} AS {m}_mean, {O.r4(f'stddev_samp({m})')} AS {m}_std" for m in _M)
    + " FROM dt GROUP BY model, budget_k"))
def q_bt_summary(spark, sf):
    return BT.backtest_summary(_backtest(spark, sf))


@register("backtest_stability", _bt_sql(
    f"""SELECT model, {O.r4('max(m)')} AS mean, {O.r4('max(s)')} AS std_pop, count(*) AS n_folds,
          count(*) FILTER (WHERE abs(v - m) > s) AS n_unstable_folds
        FROM (SELECT model, fold, v, avg(v) OVER (PARTITION BY model) AS m, stddev_pop(v) OVER (PARTITION BY model) AS s
              FROM (SELECT model, fold, avg(roc_auc) AS v FROM dt GROUP BY model, fold)) GROUP BY model"""))
def q_bt_stability(spark, sf):
    return BT.backtest_stability(_backtest(spark, sf))


def _refitted(spark, sf, names=tuple(SPECS)):
    """The backtest that refits the families in every fold (O-91)."""
    ft = cut_lineage(features(spark, sf))
    return BT.run_backtest(spark, ft, feature_columns(ft), BUDGETS, {n: SPECS[n] for n in names})[0]


@register("backtest_refit_logistic")
def q_bt_refit_logistic(spark, sf):
    return _refitted(spark, sf, ["logistic_regression"])


_REFITS: dict = {}


def _refit_detail(spark, sf):
    """The refit backtest of all families, run once in an application and written: the detail query and the
    summaries read the same rows."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _REFITS:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/backtest-refit-{uuid.uuid4().hex}"
        _refitted(spark, sf).write.parquet(path)
        _REFITS[key] = path
    return spark.read.parquet(_REFITS[key])


@register("backtest_refit_detail")
def q_bt_refit_detail(spark, sf):
    return _refit_detail(spark, sf)


@register("backtest_refit_summary")
def q_bt_refit_summary(spark, sf):
    return BT.backtest_summary(_refit_detail(spark, sf))


@register("backtest_refit_stability")
def q_bt_refit_stability(spark, sf):
    return BT.backtest_stability(_refit_detail(spark, sf))


def _fit_boosted(spark, sf, family):
    """A boosted family on the train split, calibrated on its last months, and all rows with their month's number."""
    ft = add_split(cut_lineage(features(spark, sf)), SplitConfig())
    cols = feature_columns(ft.drop("split"))
    ft = ft.withColumn("_m", BT._month_number("invoice_month"))
    months = sorted(r[0] for r in ft.filter("split = 'train'").select("_m").distinct().collect())  # a row a month
    cut = max(1, int(len(months) * 0.8))
    model = BO.grow(ft.filter("split = 'train'"), [BO.Booster(family, months[cut - 1], BO.growth(family))], cols,
                    F.col("_m"))[0]
    scored = BO.score(ft, model, cols)
    held_out = scored.filter((F.col("split") == "train") & (F.col("_m") >= months[cut])).withColumn("_g", F.lit(0))
    a, b = BO.platt(cut_lineage(held_out.select("_g", "churn_prob_raw", "churn_90d")), "_g").first()[1:]
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * F.col("churn_prob_raw") + F.lit(b))))
    return scored.withColumn("churn_prob", p), model, cols


@register("leaf_wise_scores")
def q_leaf_wise(spark, sf):
    """O-49: trees grown best leaf first to 31 leaves."""
    scored, _, _ = _fit_boosted(spark, sf, "lightgbm")
    return scored.select(*KEYS, "split", "churn_prob_raw", "churn_prob")


@register("leaf_wise_contributions")
def q_leaf_wise_contributions(spark, sf):
    """O-57c for trees: additive contributions along the paths of a fitted model."""
    scored, model, cols = _fit_boosted(spark, sf, "lightgbm")
    made = BO.explain(scored.select(*KEYS, *cols), model, cols)
    return made.select(*KEYS, "base_value", "margin", F.to_json("contributions").alias("contributions"))


@register("leaf_wise_importance")
def q_leaf_wise_importance(spark, sf):
    """O-56 for trees: mean size of the contributions over all rows."""
    scored, model, cols = _fit_boosted(spark, sf, "lightgbm")
    return BO.importance(scored.select(*cols), model, cols)


# Test trees for the SQL-checked attribution (not fitted, not from the reference): (feature, threshold) of inner
# nodes, values of all nodes; two stumps and a tree of two levels.
FIXED_CUTS = {"gap_days_prev": 45.5, "freq_90d": 1.5, "rev_sum_90d": 100000.25}
FIXED_BASE = -0.25
FIXED_TREES = [("gap_days_prev", (0.1, -0.4, 0.6)), ("rev_sum_90d", (-0.05, 0.2, -0.3))]
FIXED_DEEP = ("freq_90d", "gap_days_prev", (0.02, 0.3, -0.2, 0.05, 0.5))  # root, low, high, low's low, low's high


def fixed_booster() -> BO.Booster:
    cols = list(FEATURE_COLUMNS)
    edges = [np.array([FIXED_CUTS[c]] if c in FIXED_CUTS else []) for c in cols]

    def tree(feature, left, right, value):
        n = len(value)
        return BO.Tree(np.array(feature), np.ones(n, int), np.array(left), np.array(right), np.array(value), np.ones(n))

    trees = [tree([cols.index(c), -1, -1], [1, 0, 0], [2, 0, 0], v) for c, v in FIXED_TREES]
    root, low, v = FIXED_DEEP
    trees.append(tree([cols.index(root), cols.index(low), -1, -1, -1], [1, 3, 0, 0, 0], [2, 4, 0, 0, 0], v))
    return BO.Booster("fixed", 0, BO.Growth(), edges, np.ones(len(cols), int), FIXED_BASE, trees)


def _fixed_tree_parts() -> dict[str, str]:
    """SQL of each feature's contribution."""
    def low(c):
        return f"{c} <= {FIXED_CUTS[c]}"

    parts = {}
    for c, (top, a, b) in FIXED_TREES:
        parts[c] = f"CASE WHEN {low(c)} THEN {a - top!r} ELSE {b - top!r} END"
    root, inner, (top, a, b, aa, ab) = FIXED_DEEP
    parts[root] = f"CASE WHEN {low(root)} THEN {a - top!r} ELSE {b - top!r} END"
    parts[inner] += f" + CASE WHEN NOT ({low(root)}) THEN 0.0 WHEN {low(inner)} THEN {aa - a!r} ELSE {ab - a!r} END"
    return parts


_FIXED_START = FIXED_BASE + sum(v[0] for _, v in FIXED_TREES) + FIXED_DEEP[2][0]
_PARTS = _fixed_tree_parts()


@register("tree_path_contributions", O.with_base(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, " + ", ".join(
        f"{O.r4(e)} AS c_{c}" for c, e in _PARTS.items())
    + f", {O.r4(f'{_FIXED_START!r} + ' + ' + '.join(f'({e})' for e in _PARTS.values()))} AS margin FROM ft"))
def q_tree_paths(spark, sf):
    """O-57c: path attribution of fixed trees; base and contributions add up to the margin."""
    made = BO.explain(features(spark, sf).select(*KEYS, *FEATURE_COLUMNS), fixed_booster(), FEATURE_COLUMNS)
    at = {c: list(FEATURE_COLUMNS).index(c) for c in _PARTS}
    return made.select(*KEYS, *[F.get("contributions", F.lit(i))["contribution"].alias(f"c_{c}") for c, i in at.items()],
                       "margin")


@register("tree_path_importance", O.with_base(
    " UNION ALL ".join(f"SELECT '{c}' AS feature, " + (O.r4(f"avg(abs({_PARTS.get(c, '0.0')}))"))
                       + " AS importance FROM ft" for c in FEATURE_COLUMNS)))
def q_tree_importance(spark, sf):
    """O-56 for trees: mean absolute contribution."""
    return BO.importance(features(spark, sf).select(*FEATURE_COLUMNS), fixed_booster(), FEATURE_COLUMNS)


# Test weights for the SQL-checked explanation (not fitted, not from the reference):
# one fixed coefficient per model feature, in FEATURE_COLUMNS order.
FIXED_WEIGHTS = [0.5, -0.25, 0.1, 0.3, -0.2, 0.05, 0.4, -0.1, 0.2]
FIXED_INTERCEPT = -0.5


def _fixed_sql() -> str:
    from ..schemas import FEATURE_COLUMNS as FC
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in FC)
    contrib = [f"({c} - m_{c}) / (CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END) * {w}" for c, w in zip(FC, FIXED_WEIGHTS)]
    items = ", ".join(f"{{'c': {e}, 'f': '{c}'}}" for e, c in zip(contrib, FC))
    logit = f"{FIXED_INTERCEPT} + " + " + ".join(f"({e})" for e in contrib)
    return O.with_base(
        f"""SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {O.r4('lg')} AS logit,
              {O.r4('1.0 / (1.0 + exp(-lg))')} AS explained_probability,
              array_to_string(list_transform(list_slice(list_reverse_sort(list_filter(l, lambda x: x.c > 0)), 1, 3),
                                             lambda x: x.f), ',') AS top_positive,
              array_to_string(list_transform(list_slice(list_sort(list_filter(l, lambda x: x.c < 0)), 1, 3),
                                             lambda x: x.f), ',') AS top_negative
            FROM (SELECT ft.*, {logit} AS lg, [{items}] AS l
                  FROM ft, (SELECT {stats} FROM ft WHERE invoice_month <= DATE '1999-12-01') st)""")


@register("fixed_linear_contributions", _fixed_sql())
def q_fixed_linear(spark, sf):
    """Linear contributions with train-split standardisation and fixed test
    weights: the explanation arithmetic and top-n selection, SQL-checked."""
    from ..schemas import FEATURE_COLUMNS as FC
    ft = cut_lineage(features(spark, sf))
    train = add_split(ft, SplitConfig()).filter(F.col("split") == "train")
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in FC], *[F.stddev_samp(c).alias(f"s_{c}") for c in FC]).first()
    ex = explain_linear_params(ft, FC, FIXED_WEIGHTS, FIXED_INTERCEPT,
                               [row[f"m_{c}"] for c in FC], [row[f"s_{c}"] for c in FC], top_n=3)
    names = lambda col: F.array_join(F.transform(col, lambda x: x["feature"]), ",")
    return ex.select(*KEYS, "logit", "explained_probability",
                     names(F.col("top_positive")).alias("top_positive"),
                     names(F.col("top_negative")).alias("top_negative"))


# A raw score that any engine can compute (not fitted, not from the reference): whole days since the event before.
_RAW = "least(floor(gap_days_prev), 1000.0) / 1000.0"


def _raw_scored(spark, sf):
    return cut_lineage(features(spark, sf).select(*KEYS, "churn_90d", F.expr(_RAW).cast("double").alias("churn_prob_raw")))


_RAW_CTE = f"raw AS (SELECT CustomerID, invoice_month, churn_90d, CAST({_RAW} AS DOUBLE) AS x FROM ft)"


@register("platt_by_sums", O.with_base(f"SELECT {O.r4('a')} AS a, {O.r4('b')} AS b FROM nw WHERE k = 30", _RAW_CTE, """
nw AS (
  SELECT 0 AS k, CAST(0.0 AS DOUBLE) AS a, CAST(0.0 AS DOUBLE) AS b
  UNION ALL
  SELECT k + 1, a - greatest(-4.0, least(4.0, (hbb * ga - hab * gb) / (haa * hbb - hab * hab))),
         b - greatest(-4.0, least(4.0, (haa * gb - hab * ga) / (haa * hbb - hab * hab)))
  FROM (SELECT k, a, b, a + sum((p - churn_90d) * x) AS ga, sum(p - churn_90d) AS gb,
               1.0 + sum(p * (1 - p) * x * x) AS haa, sum(p * (1 - p) * x) AS hab, sum(p * (1 - p)) AS hbb
        FROM (SELECT k, a, b, x, churn_90d, 1.0 / (1.0 + exp(-(a * x + b))) AS p FROM nw, raw WHERE k < 30)
        GROUP BY k, a, b))""").replace("WITH ", "WITH RECURSIVE ", 1))
def q_platt_sums(spark, sf):
    """O-51: Platt parameters by Newton steps, one row of sums a step, over all rows of a fixed raw score."""
    return BO.platt(_raw_scored(spark, sf).withColumn("_g", F.lit(0)), "_g").select("a", "b")


@register("isotonic_by_counts", O.with_base(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {O.r4('x')} AS churn_prob_raw, "
    f"{O.r4('v')} AS churn_prob FROM raw JOIN fitted USING (x)", _RAW_CTE, """
cnt AS (SELECT x, row_number() OVER (ORDER BY x) AS i, sum(n) OVER (ORDER BY x) AS nn, sum(s) OVER (ORDER BY x) AS ss, n, s
        FROM (SELECT x, count(*) AS n, sum(churn_90d) AS s FROM raw GROUP BY x))""", """
fitted AS (
  SELECT c.x, max(m) AS v
  FROM (SELECT a, b, min(rate) OVER (PARTITION BY a ORDER BY b DESC) AS m
        FROM (SELECT f.i AS a, t.i AS b, (t.ss - f.ss + f.s) / CAST(t.nn - f.nn + f.n AS DOUBLE) AS rate
              FROM cnt f JOIN cnt t ON t.i >= f.i)) JOIN cnt c ON c.i = b
  GROUP BY c.x)"""))
def q_isotonic_counts(spark, sf):
    """O-52: isotonic calibration of a fixed raw score, fitted on all rows."""
    rows = _raw_scored(spark, sf)
    return CA.isotonic_transform(rows, CA.isotonic_blocks(rows)).select(*KEYS, "churn_prob_raw", "churn_prob")
