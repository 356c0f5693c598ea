"""Decision and classification metrics (O-71..O-86).

All (policy x budget x group) metrics come from *one* rank per (group, policy)
and conditional aggregates, instead of a sort per metric."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_div, top_n
from ..schemas import POLICY_COLUMNS
from .rank import exact_quantiles, global_cumsum, grouped_row_number, join_on_keys

TIE = ("CustomerID", "invoice_month")


def _policy_long(df: DataFrame, policies: Sequence[str], group_cols: Sequence[str],
                 keep: Sequence[str], include_random: bool) -> DataFrame:
    items = [F.struct(F.lit(p).alias("policy"), F.col(p).cast("double").alias("_score")) for p in policies]
    if include_random:
        items.append(F.struct(F.lit("policy_random").alias("policy"), random_score().alias("_score")))
    return (df.select(*group_cols, *keep, F.explode(F.array(*items)).alias("_p"))
              .select(*group_cols, *keep, "_p.policy", "_p._score"))


RANDOM_SEED = 42


def random_score(seed: int = RANDOM_SEED) -> Column:
    """Fixed-seed random key of a customer-month: the first 32 bits of an md5 over seed,
    customer and month. Independent of both, and any engine can compute it."""
    text = F.concat_ws("|", F.lit(str(seed)), F.col("CustomerID").cast("long").cast("string"),
                       F.date_format("invoice_month", "yyyy-MM"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")


def policy_metrics(df: DataFrame, budgets: Sequence[float], policies: Sequence[str] | None = None,
                   group_cols: Sequence[str] = (), include_random: bool = True,
                   benefit_col: str = "policy_net_benefit") -> DataFrame:
    """VaR, net benefit, targeted / captured, precision, recall, lift and VaR share
    for every policy x budget (x group) (O-71..O-74, O-77, O-78)."""
    g = list(group_cols)
    pols = [p for p in POLICY_COLUMNS if p in df.columns] if policies is None else list(policies)
    has_nb = benefit_col in df.columns
    ties = [c for c in TIE if c in df.columns]  # ids break ties where the frame has them
    include_random = include_random and len(ties) == len(TIE)
    keep = [*ties, "churn_90d", "value_pos"] + ([benefit_col] if has_nb else [])
    ks = [float(k) for k in budgets]
    long = _top_part(_policy_long(df, pols, g, keep, include_random)
                     .withColumn("_score", F.round("_score", 6)), [*g, "policy"], max(ks))
    ranked = grouped_row_number(
        long, [*g, "policy"], [F.col("_score").desc_nulls_last(), *[F.col(c) for c in ties]],
        "_rank", None)
    max_n = F.greatest(*[top_n(F.col("_n_rows"), k) for k in ks]) if len(ks) > 1 else top_n(F.col("_n_rows"), ks[0])
    top = (ranked.filter(F.col("_rank") <= max_n)
           .withColumn("budget_k", F.explode(F.array(*[F.lit(k) for k in ks])))
           .filter(F.col("_rank") <= top_n(F.col("_n_rows"), F.col("budget_k"))))
    is_churn = F.col("churn_90d") == 1
    agg = top.groupBy(*g, "policy", "budget_k").agg(
        F.count(F.lit(1)).alias("targeted_count"),
        F.sum(F.col("churn_90d")).cast("long").alias("captured_churners"),
        F.coalesce(F.sum(F.when(is_churn, F.col("value_pos"))), F.lit(0.0)).alias("value_at_risk"),
        (F.sum(F.col(benefit_col)) if has_nb else F.lit(None).cast("double")).alias("net_benefit_at_k"))
    totals = df.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.col("churn_90d")).cast("long").alias("_pos"),
        F.coalesce(F.sum(F.when(F.col("churn_90d") == 1, F.col("value_pos"))), F.lit(0.0)).alias("total_value_at_risk"))
    out = _attach_totals(agg, totals, g)
    precision = safe_div(F.col("captured_churners").cast("double"), F.col("targeted_count").cast("double"))
    base_rate = safe_div(F.col("_pos").cast("double"), F.col("_rows").cast("double"))
    return out.select(
        *g, "policy", "budget_k", "value_at_risk", "net_benefit_at_k", "total_value_at_risk",
        safe_div(F.col("value_at_risk"), F.col("total_value_at_risk")).alias("var_covered_frac"),
        F.lit(has_nb).alias("assumption_driven"),
        F.col("targeted_count").cast("long").alias("targeted_count"),
        "captured_churners",
        precision.alias("precision_at_k"),
        safe_div(F.col("captured_churners").cast("double"), F.col("_pos").cast("double")).alias("recall_at_k"),
        safe_div(precision, base_rate).alias("lift_at_k"))


# Share of rows kept beyond the largest budget: ten times the sketch's rank error.
SKETCH_ACCURACY, SKETCH_SLACK = 10_000, 1e-3


def _top_part(long: DataFrame, groups: Sequence[str], share: float) -> DataFrame:
    """Rows of each group that its best ``share`` can lie in, with the group's row count:
    those at or above a score that the sketch puts just below the cut. Nothing but
    these rows is shuffled and ranked. Groups with null scores are kept whole (nulls rank last)."""
    at = max(0.0, 1.0 - share - SKETCH_SLACK)
    cuts = long.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_n_rows"),
        F.when(F.count("_score") == F.count(F.lit(1)),
               F.percentile_approx("_score", at, SKETCH_ACCURACY)).alias("_cut"))
    return (join_on_keys(long, cuts, groups, "left", broadcast_right=True)
            .filter(F.col("_cut").isNull() | (F.col("_score") >= F.col("_cut"))).drop("_cut"))


def _attach_totals(agg: DataFrame, totals: DataFrame, g: list[str]) -> DataFrame:
    """Whole-frame totals (one row) become literals; grouped totals are joined."""
    if g:
        return join_on_keys(agg, totals, g, "left")
    row = totals.first()
    return (agg.withColumn("_rows", F.lit(row["_rows"]).cast("long"))
               .withColumn("_pos", F.lit(row["_pos"] or 0).cast("long"))
               .withColumn("total_value_at_risk", F.lit(float(row["total_value_at_risk"] or 0.0))))


def policy_frontier(df: DataFrame, policy_col: str, budgets: Sequence[float],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Budget frontier of one policy (O-76)."""
    m = policy_metrics(df, budgets, [policy_col], group_cols, include_random=False)
    return m.drop("total_value_at_risk", "assumption_driven")


def total_value_at_risk(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum(F.when(F.col("churn_90d") == 1, F.col("value_pos"))),
                             F.lit(0.0)).alias("total_value_at_risk"))


def net_benefit_comparison(df: DataFrame, baseline_col: str, comparison_col: str,
                           budgets: Sequence[float], benefit_col: str = "policy_net_benefit",
                           group_cols: Sequence[str] = ()) -> DataFrame:
    """Net benefit of two rankings and their difference (O-75)."""
    g = list(group_cols)
    m = policy_metrics(df, budgets, [baseline_col, comparison_col], g, include_random=False,
                       benefit_col=benefit_col)
    piv = m.groupBy(*g, "budget_k").agg(
        F.max(F.when(F.col("policy") == baseline_col, F.col("net_benefit_at_k"))).alias("baseline_net_benefit_at_k"),
        F.max(F.when(F.col("policy") == comparison_col, F.col("net_benefit_at_k"))).alias("comparison_net_benefit_at_k"))
    return piv.withColumn("comparison_minus_baseline",
                          F.col("comparison_net_benefit_at_k") - F.col("baseline_net_benefit_at_k"))


# ---------------------------------------------------------------- classification

def _score_table(df: DataFrame, label: str, prob: str, group_cols: Sequence[str]) -> DataFrame:
    """Counts per distinct score: the only table AUC, AP and the curves need."""
    return (df.filter(F.col(prob).isNotNull())
              .groupBy(*group_cols, F.col(prob).cast("double").alias("score"))
              .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                   F.count(F.lit(1)).alias("cnt")))


def _cumulative(df: DataFrame, label: str, prob: str, group_cols: Sequence[str]) -> DataFrame:
    """Per distinct score (descending): tp / pp = positives / rows with score >= s,
    plus group totals P and N. Grouped: group starts and totals (one row per
    group) are joined on the group key; whole frame: they are scalars."""
    g = list(group_cols)
    st = _score_table(df, label, prob, g)
    cum = global_cumsum(st, [*[F.col(c) for c in g], F.col("score").desc()], ["pos", "cnt"])
    if g:
        starts = cum.groupBy(*g).agg(F.min(F.col("cum_pos") - F.col("pos")).alias("_sp"),
                                     F.min(F.col("cum_cnt") - F.col("cnt")).alias("_sc"),
                                     F.sum("pos").alias("P"), F.sum("cnt").alias("_rows"))
        cum = join_on_keys(cum, starts, g, "left", broadcast_right=True)
    else:
        t = st.agg(F.sum("pos").alias("P"), F.sum("cnt").alias("_rows")).first()
        cum = (cum.withColumn("_sp", F.lit(0)).withColumn("_sc", F.lit(0))
                  .withColumn("P", F.lit(t["P"] or 0).cast("long"))
                  .withColumn("_rows", F.lit(t["_rows"] or 0).cast("long")))
    return (cum.withColumn("tp", F.col("cum_pos") - F.col("_sp"))
               .withColumn("pp", F.col("cum_cnt") - F.col("_sc"))
               .withColumn("N", F.col("_rows") - F.col("P"))
               .drop("cum_pos", "cum_cnt", "_sp", "_sc"))


def classification_summary(df: DataFrame, label: str = "churn_90d", prob: str = "churn_prob",
                           group_cols: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count one half), average precision (sum of dR * P over
    distinct thresholds), Brier score and positive rate (O-81). A group with a
    single class has no AUC / AP (NULL)."""
    g = list(group_cols)
    cum = _cumulative(df, label, prob, g)
    neg = F.col("cnt") - F.col("pos")
    # each negative at score s beats the positives strictly above it; ties count half
    auc_term = neg * ((F.col("tp") - F.col("pos")) + F.col("pos") / 2.0)
    ap_term = F.col("pos") * F.col("tp") / F.col("pp")
    curves = cum.groupBy(*g).agg(
        F.try_divide(F.sum(auc_term), (F.max("P") * F.max("N")).cast("double")).alias("roc_auc"),
        F.try_divide(F.sum(ap_term), F.max("P").cast("double")).alias("pr_auc"))
    base = df.groupBy(*g).agg(
        F.avg((F.col(prob) - F.col(label)) ** 2).alias("brier_score"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"))
    if g:
        return join_on_keys(base, curves, g, "left").select(*g, "roc_auc", "pr_auc", "brier_score", "positive_rate")
    c, b = curves.first(), base.first()  # one row each
    spark = df.sparkSession
    return spark.createDataFrame(
        [(c["roc_auc"] if c else None, c["pr_auc"] if c else None, b["brier_score"], b["positive_rate"])],
        "roc_auc double, pr_auc double, brier_score double, positive_rate double")


def roc_points(df: DataFrame, label: str = "churn_90d", prob: str = "churn_prob",
               group_cols: Sequence[str] = ()) -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score, plus the origin (O-82)."""
    g = list(group_cols)
    cum = _cumulative(df, label, prob, g)
    pts = cum.select(*g, safe_div(F.col("pp") - F.col("tp"), F.col("N")).alias("fpr"),
                     safe_div(F.col("tp"), F.col("P")).alias("tpr"), F.col("score").alias("threshold"))
    origin = cum.select(*g, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                        F.lit(float("inf")).alias("threshold")).limit(1) if not g else \
        cum.select(*g).distinct().select(*g, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                                         F.lit(float("inf")).alias("threshold"))
    return pts.unionByName(origin)


def pr_points(df: DataFrame, label: str = "churn_90d", prob: str = "churn_prob",
              group_cols: Sequence[str] = ()) -> DataFrame:
    """(precision, recall, threshold) at every distinct score plus the final
    (precision 1, recall 0) point (O-83)."""
    g = list(group_cols)
    cum = _cumulative(df, label, prob, g)
    pts = cum.select(*g, (F.col("tp") / F.col("pp")).alias("precision"),
                     safe_div(F.col("tp"), F.col("P")).alias("recall"), F.col("score").alias("threshold"))
    end = (cum.select(*g).distinct() if g else cum.limit(1).select()).select(
        *g, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold"))
    return pts.unionByName(end)


def calibration_curve(df: DataFrame, label: str = "churn_90d", prob: str = "churn_prob",
                      n_bins: int = 10, group_cols: Sequence[str] = ()) -> DataFrame:
    """Quantile-binned reliability table; a score equal to an edge falls in the
    lower bin; empty bins are absent (O-84)."""
    g = list(group_cols)
    probs = [i / n_bins for i in range(1, n_bins)]
    q = exact_quantiles(df, g, prob, probs, bounded_groups=True)
    edges = q.groupBy(*g).agg(F.array_sort(F.collect_list("value")).alias("_edges"))
    j = df.select(*g, F.col(prob).cast("double").alias("_p"), F.col(label).cast("double").alias("_y"))
    j = join_on_keys(j, edges, g, "left", broadcast_right=True) if g else _attach_edges(j, edges)
    binned = j.withColumn("bin", F.size(F.filter("_edges", lambda e: e < F.col("_p"))))
    return binned.groupBy(*g, "bin").agg(F.avg("_p").alias("mean_predicted_probability"),
                                         F.avg("_y").alias("observed_positive_rate"))


def _attach_edges(j: DataFrame, edges: DataFrame) -> DataFrame:
    row = edges.first()
    arr = row["_edges"] if row else []
    return j.withColumn("_edges", F.array(*[F.lit(float(e)) for e in arr]).cast("array<double>"))


# ---------------------------------------------------------------- segments

def add_segment_columns(df: DataFrame) -> DataFrame:
    """Right-closed bands (O-79). Null inputs stay null (own group)."""
    # Band edges and labels of the reference.
    def band(c: str, lo: float, hi: float, names: tuple[str, str, str]) -> Column:
        x = F.col(c).cast("double")
        return (F.when(x <= lo, names[0]).when(x <= hi, names[1])
                 .when(x.isNotNull(), names[2]))
    return (df.withColumn("segment_value_band", band("rev_sum_90d", 50.0, 200.0,
                                                     ("low_value", "mid_value", "high_value")))
              .withColumn("segment_recency_bucket", band("gap_days_prev", 30.0, 90.0,
                                                         ("recent", "warming", "stale")))
              .withColumn("segment_frequency_bucket", band("freq_90d", 2.0, 5.0,
                                                           ("low_frequency", "mid_frequency", "high_frequency"))))


SEGMENT_TYPES = ("segment_value_band", "segment_recency_bucket", "segment_frequency_bucket")


def segment_long(df: DataFrame) -> DataFrame:
    """One row per (row, segment type): the three groupings become one grouping key."""
    seg = add_segment_columns(df)
    items = [F.struct(F.lit(t).alias("segment_type"), F.col(t).alias("segment_value")) for t in SEGMENT_TYPES]
    return seg.withColumn("_s", F.explode(F.array(*items))).select("*", "_s.segment_type", "_s.segment_value").drop("_s")


def evaluate_segments(df: DataFrame, budgets: Sequence[float], policy_col: str = "policy_net_benefit",
                      chosen_budget: float | None = None, min_rows: int = 5) -> DataFrame:
    """Per segment: classification metrics and the frontier row at the chosen
    budget; segments with < min_rows rows or one class are skipped (O-80)."""
    chosen = chosen_budget if chosen_budget is not None else (0.10 if 0.10 in budgets else float(budgets[0]))
    g = ["segment_type", "segment_value"]
    long = segment_long(df)
    stats = long.groupBy(*g).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.countDistinct("churn_90d").alias("_classes"),
                                 F.avg(F.col("churn_90d").cast("double")).alias("positive_rate"))
    ok = stats.filter((F.col("n_rows") >= min_rows) & (F.col("_classes") >= 2)).drop("_classes")
    use = join_on_keys(long, ok.select(*g), g, "left_semi", broadcast_right=True)
    cls = classification_summary(use, group_cols=g).drop("positive_rate")
    fr = policy_frontier(use, policy_col, [chosen], g)
    return join_on_keys(join_on_keys(ok, cls, g, "inner"), fr, g, "inner")


def pick_policy_row(metrics: DataFrame, budget: float, policy: str = "policy_ml"):
    """Exactly one (policy, budget) row or an error (O-89). Budgets are matched on
    the rounded percent, not float equality."""
    rows = (metrics.filter((F.col("policy") == policy)
                           & (F.round(F.col("budget_k") * 100) == F.lit(round(budget * 100))))
                   .limit(2).collect())
    if len(rows) != 1:
        raise ValueError(f"{len(rows)} rows for {policy} at budget {budget}, one is needed")
    return rows[0]


def curve_tables(df: DataFrame, group_cols: Sequence[str] = (), label: str = "churn_90d",
                 prob: str = "churn_prob") -> DataFrame:
    """ROC, PR and calibration points as one long table keyed by ``curve`` (O-85)."""
    g = list(group_cols)
    roc = roc_points(df, label, prob, g).select(*g, F.lit("roc").alias("curve"), F.col("fpr").alias("x"),
                                                F.col("tpr").alias("y"), "threshold")
    pr = pr_points(df, label, prob, g).select(*g, F.lit("pr").alias("curve"), F.col("recall").alias("x"),
                                              F.col("precision").alias("y"), "threshold")
    cal = calibration_curve(df, label, prob, 10, g).select(
        *g, F.lit("calibration").alias("curve"), F.col("mean_predicted_probability").alias("x"),
        F.col("observed_positive_rate").alias("y"), F.lit(None).cast("double").alias("threshold"))
    return roc.unionByName(pr).unionByName(cal)
