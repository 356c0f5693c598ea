"""Feature and decision drift (O-101..O-110).

Profiles are flat tables -- (feature, bin, lo, hi, count) -- built from exact
distributed quantiles; nothing is collected except bin edges (<= n_bins per
feature)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import AlertConfig
from .evaluate import TIE
from ..session import cut_lineage
from .rank import exact_quantiles, quantiles_of, value_counts
from .selection import top_rows

EPS = 1e-8


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(F.explode(F.array(*items)).alias("_f")).select("_f.feature", "_f.value")


def bin_edges(reference: DataFrame, cols: Sequence[str], n_bins: int = 10) -> DataFrame:
    """Interior edges per feature: unique linear quantiles at 0, 1/n, ..., 1 minus
    the two ends; empty or constant features get no interior edge (one bin)."""
    return _edges(_quantiles(_counts(reference, cols), _grid(n_bins)), cols, n_bins)


def _counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows by feature and value: all that profiles, drift and statistics read of the rows."""
    return value_counts(_long(df, cols), ["feature"], "value")


def _grid(n_bins: int) -> list[float]:
    return [i / n_bins for i in range(n_bins + 1)]


def _quantiles(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    return quantiles_of(counts, ["feature"], sorted(set(probs)), bounded_groups=True)  # one group per feature


def _edges(quantiles: DataFrame, cols: Sequence[str], n_bins: int) -> DataFrame:
    q = quantiles.filter(F.col("q").isin(_grid(n_bins)))
    uniq = q.groupBy("feature").agg(F.array_sort(F.array_distinct(F.collect_list("value"))).alias("_u"))
    feats = quantiles.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    edges = F.when(F.size("_u") > 2, F.slice("_u", 2, F.size("_u") - 2)).otherwise(F.array().cast("array<double>"))
    # one row per feature: cut so the histogram and bounds below reuse it
    return cut_lineage(feats.join(uniq, "feature", "left").select("feature", edges.alias("edges")))


def _bin_of(value, edges):
    """np.histogram bins with -inf / +inf ends: index = #edges <= value."""
    return F.size(F.filter(edges, lambda e: e <= value))


def histogram(df: DataFrame, edges: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, bin, count) for every bin of every feature, empty bins included."""
    return _histogram(_long(df, cols).select("feature", F.col("value").alias("_v"), F.lit(1).alias("_c")), edges)


def _histogram(values: DataFrame, edges: DataFrame) -> DataFrame:
    e = F.broadcast(edges)  # one row per feature
    counts = (values.filter(F.col("_v").isNotNull()).join(e, "feature")
                    .withColumn("bin", _bin_of(F.col("_v"), F.col("edges")))
                    .groupBy("feature", "bin").agg(F.sum("_c").alias("count")))
    all_bins = edges.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("bin"))
    return (all_bins.join(counts, ["feature", "bin"], "left")
                    .select("feature", "bin", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def missing_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    long = _long(df, cols)
    return long.groupBy("feature").agg(F.avg(F.col("value").isNull().cast("double")).alias("missing_rate"))


STATISTICS = ("n_rows", "mean", "p50", "p90", "p99")
STATISTIC_PROBS = (0.5, 0.9, 0.99)


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: rows, missing rate, mean and exact p50 / p90 / p99 of what is not null."""
    counts = _counts(df, cols)
    return _stats(counts, _quantiles(counts, STATISTIC_PROBS))


def _stats(counts: DataFrame, quantiles: DataFrame) -> DataFrame:
    held = F.when(F.col("_v").isNotNull(), F.col("_c"))
    base = counts.groupBy("feature").agg(
        F.sum("_c").alias("n_rows"), (F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_c"))), F.lit(0))
                                      / F.sum("_c")).alias("missing_rate"),
        (F.sum(F.col("_v") * F.col("_c")) / F.sum(held)).alias("mean"))
    points = quantiles.groupBy("feature").agg(*[F.max(F.when(F.col("q") == p, F.col("value"))).alias(n)
                                                for p, n in zip(STATISTIC_PROBS, STATISTICS[2:], strict=True)])
    return base.join(F.broadcast(points), "feature", "left")  # a row a column


def reference_profile(reference: DataFrame, cols: Sequence[str], n_bins: int = 10) -> DataFrame:
    """Flat profile (O-101..O-103), a row per bin: feature, bin, lo, hi, count, and the column's
    n_bins, missing_rate, n_rows, mean, p50, p90, p99. Give the score among ``cols`` to profile it."""
    counts = _counts(reference, cols)
    quantiles = cut_lineage(_quantiles(counts, [*_grid(n_bins), *STATISTIC_PROBS]))  # a few rows a feature
    edges = _edges(quantiles, cols, n_bins)
    hist = _histogram(counts, edges)
    bounds = F.concat(F.array(F.lit(float("-inf"))), F.col("edges"), F.array(F.lit(float("inf"))))
    with_b = hist.join(F.broadcast(edges), "feature").withColumn("_b", bounds)
    prof = with_b.select("feature", "bin", F.element_at("_b", F.col("bin") + 1).alias("lo"),
                         F.element_at("_b", F.col("bin") + 2).alias("hi"), "count",
                         (F.size("edges") + 1).cast("long").alias("n_bins"))
    # features x bins rows: materialised once, read by every drift comparison
    return cut_lineage(prof.join(F.broadcast(_stats(counts, quantiles)), "feature", "left"))


def score_stats(df: DataFrame, prob: str = "churn_prob") -> DataFrame:
    """missing rate, mean, p50 / p90 / p99 (exact linear quantiles); one row."""
    q = {r["q"]: r["value"] for r in exact_quantiles(df, [], prob, [0.5, 0.9, 0.99]).collect()}  # 3 rows
    b = df.agg(F.avg(F.col(prob).isNull().cast("double")).alias("missing_rate"), F.avg(prob).alias("mean")).first()
    return df.sparkSession.createDataFrame(
        [(b["missing_rate"], b["mean"], q.get(0.5), q.get(0.9), q.get(0.99))],
        "missing_rate double, mean double, p50 double, p90 double, p99 double")


def psi_table(profile: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PSI per feature with eps added to every count (O-104)."""
    return _psi(profile, _counts(current, cols))


def _psi(profile: DataFrame, counts: DataFrame) -> DataFrame:
    edges = profile.groupBy("feature").agg(
        F.array_sort(F.collect_list(F.when(F.col("bin") > 0, F.col("lo")))).alias("edges"))
    edges = edges.select("feature", F.filter("edges", lambda x: x.isNotNull()).alias("edges"))
    cur = _histogram(counts, edges)
    j = (profile.select("feature", "bin", F.col("count").alias("expected"))
                .join(cur.withColumnRenamed("count", "actual"), ["feature", "bin"], "left")
                .fillna(0, subset=["actual"]))
    j = j.withColumn("e", F.col("expected") + EPS).withColumn("a", F.col("actual") + EPS)
    w = Window.partitionBy("feature")  # one partition per feature, <= n_bins rows each
    j = (j.withColumn("e", F.col("e") / F.sum("e").over(w))
          .withColumn("a", F.col("a") / F.sum("a").over(w)))
    return j.groupBy("feature").agg(F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi"))


def drift_report(profile: DataFrame, current: DataFrame, cols: Sequence[str],
                 cfg: AlertConfig | None = None) -> DataFrame:
    """Per column: current missing rate, PSI, status, bins, and rows, mean, p50, p90, p99 of the
    reference and of now (O-105). Profiles written without statistics give nulls for theirs."""
    cfg = cfg or AlertConfig()
    present = [c for c in cols if c in current.columns]
    counts = _counts(current, present)
    psi = _psi(profile, counts)
    now = _stats(counts, _quantiles(counts, STATISTIC_PROBS)).withColumnRenamed("missing_rate", "missing_rate_current")
    now = now.withColumnsRenamed({c: f"{c}_current" for c in STATISTICS})
    ref = profile.groupBy("feature").agg(F.lit(True).alias("_ref"), F.count(F.lit(1)).alias("n_bins"), *[
        (F.max(c) if c in profile.columns else F.lit(None).cast("long" if c == "n_rows" else "double"))
        .alias(f"{c}_reference") for c in STATISTICS])
    out = now.join(ref, "feature", "left").join(psi, "feature", "left")
    status = (F.when(F.col("_ref").isNull(), "no_reference")
               .when(F.col("psi") >= cfg.alert_threshold, "alert")
               .when(F.col("psi") >= cfg.warn_threshold, "warn").otherwise("ok"))
    return out.select("feature", "missing_rate_current",
                      F.when(F.col("_ref").isNotNull(), F.col("psi")).alias("psi"), status.alias("status"), "n_bins",
                      *[f"{c}_{when}" for c in STATISTICS for when in ("reference", "current")])


def score_statistics(profile: DataFrame, current: DataFrame, prob: str = "churn_prob") -> DataFrame:
    """Rows, missing rate, mean, p50, p90, p99 of the score: a row for now (``part`` current) and,
    if the profile holds the score, one for the reference. No PSI: the score raises no alert."""
    cols = ["n_rows", "missing_rate", *STATISTICS[1:]]
    now = column_stats(current, [prob]).select(F.lit("current").alias("part"), *cols)
    ref = profile.filter((F.col("feature") == prob) & (F.col("bin") == 0))  # statistics repeat on every bin
    return now.unionByName(ref.select(F.lit("reference").alias("part"), *[
        F.col(c) if c in profile.columns else F.lit(None).cast("double").alias(c) for c in cols]))


def drift_summary(report: DataFrame) -> DataFrame:
    """Counts by status, overall status, top feature (O-106, O-108)."""
    return report.agg(
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "warn").alias("n_warn"),
        F.count_if(F.col("status") == "alert").alias("n_alert"),
        F.count_if(F.col("status") == "no_reference").alias("n_missing_ref"),
        F.max_by("feature", "psi").alias("top_alert_feature"),
        F.max("psi").alias("top_psi"),
    ).withColumn("overall_status", F.when(F.col("n_alert") > 0, "alert")
                 .when(F.col("n_warn") > 0, "warn").otherwise("ok")
    ).withColumn("has_alerts", F.col("n_alert") > 0).withColumn("has_warnings", F.col("n_warn") > 0)


def alert_lists(report: DataFrame) -> DataFrame:
    """One row: the features at alert and at warning, in name order (O-106)."""
    def named(status: str):
        return F.sort_array(F.collect_list(F.when(F.col("status") == status, F.col("feature"))))

    return report.agg(named("alert").alias("alert_features"), named("warn").alias("warn_features"))


def top_psi_features(report: DataFrame, top_n_rows: int = 10) -> DataFrame:
    """Top features by PSI (O-66); a limit is the feature here."""
    return report.filter(F.col("psi").isNotNull()).orderBy(F.col("psi").desc(), "feature").limit(top_n_rows)


def drift_history_row(report: DataFrame, current: DataFrame, generated_at: str,
                      prob: str = "churn_prob") -> DataFrame:
    """One history row per run (O-108), appended by the score job."""
    s = drift_summary(report).first().asDict()
    st = score_stats(current, prob).first()
    n = current.count()
    row = {**s, "n_alert_features": s["n_alert"], "n_warn_features": s["n_warn"], "score_mean": st["mean"], "score_p90": st["p90"], "score_p99": st["p99"],
           "n_rows_current": n, "generated_at_utc": generated_at}
    schema = ("n_ok bigint, n_warn bigint, n_alert bigint, n_missing_ref bigint, top_alert_feature string, "
              "top_psi double, overall_status string, has_alerts boolean, has_warnings boolean, "
              "n_alert_features bigint, n_warn_features bigint, "
              "score_mean double, score_p90 double, score_p99 double, n_rows_current bigint, generated_at_utc string")
    cols = [c.split()[0] for c in schema.split(", ")]
    return current.sparkSession.createDataFrame([tuple(row[c] for c in cols)], schema)


def history_trend(history: DataFrame) -> DataFrame:
    """Latest vs previous run of the drift history (one row per run, small)."""
    w = Window.orderBy("generated_at_utc")
    return history.withColumn("previous_top_psi", F.lag("top_psi").over(w)).withColumn(
        "psi_change", F.col("top_psi") - F.col("previous_top_psi"))


def decision_drift(df: DataFrame, budgets: Sequence[float], ranking_col: str, digits: int | None = None) -> DataFrame:
    """Per month x budget: selection size and averages of the month's top-k (O-64, O-109).
    Each month's borders are found by counting, so a hot month is neither sorted nor moved.
    ``digits`` rounds the ranking score before it is compared."""
    keep = [*TIE, "churn_prob", "value_pos", "churn_90d", "policy_net_benefit"]
    base = df.select(*dict.fromkeys(keep), F.col(ranking_col).alias("_score"))
    top = top_rows(base, "_score", budgets, ["invoice_month"], TIE, digits)
    return top.groupBy("invoice_month", "budget_k").agg(
        F.lit(ranking_col).alias("ranking_policy"),
        F.max("_n_rows").alias("n_rows"), F.max("_n").alias("selected_count"),
        (F.max("_n") / F.max("_n_rows")).alias("selected_share"),
        F.avg("churn_prob").alias("avg_churn_prob_top_k"),
        F.avg("value_pos").alias("avg_value_pos_top_k"),
        F.coalesce(F.sum(F.when(F.col("churn_90d") == 1, F.col("value_pos"))), F.lit(0.0)).alias("var_at_k"),
        F.avg("policy_net_benefit").alias("avg_policy_net_benefit_top_k"))


def monthly_psi(profile: DataFrame, current: DataFrame, cols: Sequence[str],
                month_col: str = "invoice_month") -> DataFrame:
    """PSI of every feature for every month of ``current`` against the reference
    profile: (month, feature, psi). Counts are one aggregate by (month, feature,
    bin); empty bins are generated from each (month, feature) pair's edge list."""
    edges = profile.groupBy("feature").agg(
        F.array_sort(F.collect_list(F.when(F.col("bin") > 0, F.col("lo")))).alias("edges"))
    edges = F.broadcast(edges.select("feature", F.filter("edges", lambda x: x.isNotNull()).alias("edges")))
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    long = (current.select(F.col(month_col).alias("month"), F.explode(F.array(*items)).alias("_f"))
                   .select("month", "_f.feature", "_f.value").filter(F.col("value").isNotNull()))
    counts = (long.join(edges, "feature").withColumn("bin", _bin_of(F.col("value"), F.col("edges")))
                  .groupBy("month", "feature", "bin").agg(F.count(F.lit(1)).alias("actual")))
    pairs = counts.select("month", "feature").distinct().join(edges, "feature")
    all_bins = pairs.select("month", "feature", F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("bin"))
    ref = F.broadcast(profile.select("feature", "bin", F.col("count").alias("expected")))
    j = (all_bins.join(counts, ["month", "feature", "bin"], "left").join(ref, ["feature", "bin"], "left")
                 .fillna(0, subset=["actual", "expected"]))
    j = j.withColumn("e", F.col("expected") + EPS).withColumn("a", F.col("actual") + EPS)
    w = Window.partitionBy("month", "feature")  # <= n_bins + 1 rows per group
    j = (j.withColumn("e", F.col("e") / F.sum("e").over(w)).withColumn("a", F.col("a") / F.sum("a").over(w)))
    return j.groupBy("month", "feature").agg(
        F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi"))


def psi_trend(monthly: DataFrame) -> DataFrame:
    """Per month: top feature and top PSI, with the change from the previous month
    (O-110 over time). The month table is one row per month."""
    top = monthly.groupBy("month").agg(F.max_by("feature", "psi").alias("top_feature"),
                                       F.max("psi").alias("top_psi"))
    w = Window.orderBy("month")  # one row per month: a small ordered table
    return (top.withColumn("previous_top_psi", F.lag("top_psi").over(w))
               .withColumn("psi_change", F.col("top_psi") - F.col("previous_top_psi")))
