"""Point-in-time features, churn label and future value (O-32..O-42).

Every window is a *time-range frame* over one customer's events:

* trailing frames (T - N days, T] for N in 30 / 90 / 180 (left-open: an event
  exactly N days old is out, the event at T is in),
* the forward frame (T, T + horizon] for the label and the future value,
* lag / lead for the previous event and for "last event of the month".

Skew: a single customer may own a large share of all events, and a window
partitioned only by customer would put all of them in one task. Windows are
therefore partitioned by ``(CustomerID, time bucket)``. A bucket is
``bucket_days`` wide (default 2 x the longest look-back); an event is copied
into the next bucket when it lies in the last ``max window`` days of its own
bucket (look-back halo) and into the previous bucket when it lies in the first
``horizon`` days (look-ahead halo). Every frame of a row whose home is bucket b
is then complete inside partition (customer, b); rows are kept only in their
home bucket. The only quantity a bounded halo cannot give is the previous event
when it is older than the halo (gap > max window); that comes from a tiny
per-(customer, bucket) summary. Replication is at most
1 + (max window + horizon) / bucket_days (1.75x by default), through one
shuffle, and the hottest customer is spread over (time span / bucket) tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import HORIZON_DAYS
from ..functions.columns import US_PER_DAY, floor_div, ntz_micros
from .grains import add_invoice_month

# Feature windows of the reference (days).
SHORT, MID, LONG = 30, 90, 180
FIRST_EVENT_GAP = 999.0


def _bucketed(df: DataFrame, bucket_days: int, back_days: int, fwd_days: int) -> DataFrame:
    """Add ``_us`` and explode every row into its home bucket plus halo buckets."""
    bucket = bucket_days * US_PER_DAY
    us = ntz_micros("InvoiceDate")
    df = df.withColumn("_us", us).withColumn("_home", floor_div("_us", bucket))
    off = F.pmod(F.col("_us"), F.lit(bucket))
    parts = F.array(F.col("_home"),
                    F.when(off >= F.lit(bucket - back_days * US_PER_DAY), F.col("_home") + 1),
                    F.when(off < F.lit(fwd_days * US_PER_DAY), F.col("_home") - 1))
    return df.withColumn("_part", F.explode(F.filter(parts, lambda p: p.isNotNull())))


def _frame(w, days_back: int | None = None, days_fwd: int | None = None):
    if days_back is not None:
        return w.rangeBetween(-days_back * US_PER_DAY + 1, 0)
    return w.rangeBetween(1, days_fwd * US_PER_DAY)


def _window_columns(w, rev: str, weight=None):
    """Trailing-feature expressions. ``weight`` masks rows that are not events
    (used when query points are mixed into the frame)."""
    r = F.col(rev) if weight is None else F.when(weight, F.col(rev))
    ret = (F.col(rev) < 0).cast("int") if weight is None else F.when(weight, (F.col(rev) < 0).cast("int"))
    return [
        F.sum(r).over(_frame(w, SHORT)).alias("rev_sum_30d"),
        F.sum(r).over(_frame(w, MID)).alias("rev_sum_90d"),
        F.sum(r).over(_frame(w, LONG)).alias("rev_sum_180d"),
        F.count(r).over(_frame(w, SHORT)).cast("double").alias("freq_30d"),
        F.count(r).over(_frame(w, MID)).cast("double").alias("freq_90d"),
        F.stddev_samp(r).over(_frame(w, MID)).alias("rev_std_90d"),
        F.sum(ret).over(_frame(w, MID)).cast("double").alias("return_count_90d"),
        F.avg(r).over(_frame(w, MID)).alias("aov_90d"),
    ]


def _bucket_days(bucket_days: int | None, horizon_days: int) -> int:
    out = bucket_days or 2 * max(LONG, horizon_days, MONTH_DAYS)
    if out < max(LONG, horizon_days):
        raise ValueError("bucket_days must be >= the longest window and the horizon")
    return out


# The last event of a month must see the next event of that month across a bucket border.
MONTH_DAYS = 31


def _event_level(invoices: DataFrame, horizon_days: int, bucket_days: int | None) -> DataFrame:
    """Events (customer, timestamp) in their (customer, bucket) partitions with
    every window evaluated; only home rows are returned."""
    back = LONG
    bucket_days = _bucket_days(bucket_days, horizon_days)
    forward = max(horizon_days, MONTH_DAYS)
    x = (_bucketed(invoices.select("CustomerID", "InvoiceDate", "invoice_total_revenue",
                                   "invoice_total_quantity", "num_lines"),
                   bucket_days, back, forward)
         .repartition("CustomerID", "_part"))
    ev = (x.groupBy("CustomerID", "_part", "_us")
          .agg(F.max("InvoiceDate").alias("InvoiceDate"),
               F.max("_home").alias("_home"),
               F.sum("invoice_total_revenue").alias("event_revenue"),
               F.sum("invoice_total_quantity").alias("event_quantity"),
               F.sum("num_lines").alias("event_num_invoices"),
               F.count(F.lit(1)).alias("event_invoice_count")))
    w = Window.partitionBy("CustomerID", "_part").orderBy("_us")
    out = ev.select(
        "CustomerID", "_part", "_home", "_us", "InvoiceDate", "event_revenue", "event_quantity",
        "event_num_invoices", "event_invoice_count",
        *_window_columns(w, "event_revenue"),
        F.lag("InvoiceDate").over(w).alias("prev_event_ts"),
        F.lag("_us").over(w).alias("_prev_us"),
        F.lead("InvoiceDate").over(w).alias("_next_ts"),
        F.count(F.lit(1)).over(_frame(w, days_fwd=horizon_days)).alias("_n_future"),
        F.sum("event_revenue").over(_frame(w, days_fwd=horizon_days)).alias("_future_rev"),
    )
    return out.filter(F.col("_part") == F.col("_home"))


def _bucket_fallback(invoices: DataFrame, bucket_days: int) -> DataFrame:
    """Latest event strictly before each (customer, bucket): one row per
    (customer, bucket) with partial aggregation; the per-customer window only
    spans that customer's bucket count (time span / bucket), never its events."""
    bucket = bucket_days * US_PER_DAY
    per_bucket = (invoices.select("CustomerID", "InvoiceDate")
                  .withColumn("_us", ntz_micros("InvoiceDate"))
                  .withColumn("_part", floor_div("_us", bucket))
                  .groupBy("CustomerID", "_part")
                  .agg(F.max("_us").alias("_bmax_us"), F.max("InvoiceDate").alias("_bmax_ts")))
    wb = Window.partitionBy("CustomerID").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select("CustomerID", "_part",
                             F.max("_bmax_us").over(wb).alias("_fb_us"),
                             F.max("_bmax_ts").over(wb).alias("_fb_ts"))


def _with_previous(rows: DataFrame, invoices: DataFrame, bucket_days: int) -> DataFrame:
    fb = _bucket_fallback(invoices, bucket_days)
    j = rows.join(fb, ["CustomerID", "_part"], "left")
    prev_us = F.coalesce(F.col("_prev_us"), F.col("_fb_us"))
    return (j.withColumn("prev_event_ts", F.coalesce(F.col("prev_event_ts"), F.col("_fb_ts")))
            .withColumn("gap_days_prev",
                        F.coalesce(((F.col("_us") - prev_us) / F.lit(float(US_PER_DAY))),
                                   F.lit(FIRST_EVENT_GAP))))


FEATURE_OUTPUT = ["CustomerID", "invoice_month", "T", "has_future_purchase_90d", "churn_90d",
                  "rev_sum_30d", "rev_sum_90d", "rev_sum_180d", "freq_30d", "freq_90d",
                  "rev_std_90d", "return_count_90d", "aov_90d", "prev_event_ts",
                  "gap_days_prev", "customer_value_90d"]


def event_features(invoices: DataFrame, horizon_days: int = HORIZON_DAYS,
                   bucket_days: int | None = None) -> DataFrame:
    """Event grain: every (CustomerID, InvoiceDate) with its trailing features,
    previous-event gap, forward label and forward value."""
    ev = _event_level(invoices, horizon_days, bucket_days)
    ev = _with_previous(ev, invoices, _bucket_days(bucket_days, horizon_days))
    return ev.select(
        "CustomerID", "InvoiceDate", "event_revenue", "event_quantity", "event_num_invoices",
        "event_invoice_count", "rev_sum_30d", "rev_sum_90d", "rev_sum_180d", "freq_30d",
        "freq_90d", "rev_std_90d", "return_count_90d", "aov_90d", "prev_event_ts",
        "gap_days_prev", (F.col("_n_future") > 0).alias("has_future_purchase_90d"),
        F.coalesce(F.col("_future_rev"), F.lit(0.0)).alias("customer_value_90d"))


def feature_table(invoices: DataFrame, horizon_days: int = HORIZON_DAYS,
                  bucket_days: int | None = None) -> DataFrame:
    """The whole feature build (customer-month rows, label, features, value) as
    one lazy plan. T is the last event of the month, so every trailing window
    and the label are read off that event's row: no join with the events."""
    ev = _event_level(invoices, horizon_days, bucket_days)
    month_end = ev.filter(F.col("_next_ts").isNull()
                          | (F.trunc(F.col("_next_ts").cast("date"), "MM")
                             != F.trunc(F.col("InvoiceDate").cast("date"), "MM")))
    ft = _with_previous(month_end, invoices, _bucket_days(bucket_days, horizon_days))
    ft = add_invoice_month(ft.withColumnRenamed("InvoiceDate", "T"), "T")
    has_future = F.col("_n_future") > 0
    ft = (ft.withColumn("has_future_purchase_90d", has_future)
            .withColumn("churn_90d", (~has_future).cast("int"))
            .withColumn("customer_value_90d", F.coalesce(F.col("_future_rev"), F.lit(0.0))))
    fills = ["rev_sum_30d", "rev_sum_90d", "rev_sum_180d", "freq_30d", "freq_90d",
             "rev_std_90d", "return_count_90d", "aov_90d"]
    ft = ft.fillna(0.0, subset=fills)
    return ft.select(*FEATURE_OUTPUT)


def label_at_points(points: DataFrame, events: DataFrame, horizon_days: int = HORIZON_DAYS,
                    bucket_days: int | None = None) -> DataFrame:
    """General label / value for arbitrary cut-off rows (CustomerID, invoice_month, T)
    that need not be event timestamps: query points are mixed into the same
    bucketed forward frames (no per-customer cross product).

    events: CustomerID, InvoiceDate, event_revenue."""
    bucket_days = bucket_days or 2 * horizon_days
    ev = events.select("CustomerID", "InvoiceDate", "event_revenue",
                       F.lit(None).cast("date").alias("invoice_month"), F.lit(0).alias("_kind"))
    pt = points.select("CustomerID", F.col("T").alias("InvoiceDate"),
                       F.lit(None).cast("double").alias("event_revenue"),
                       "invoice_month", F.lit(1).alias("_kind"))
    x = _bucketed(ev.unionByName(pt), bucket_days, 0, horizon_days)
    # query points only need their home bucket
    x = x.filter((F.col("_kind") == 0) | (F.col("_part") == F.col("_home"))).repartition("CustomerID", "_part")
    w = Window.partitionBy("CustomerID", "_part").orderBy("_us")
    is_ev = F.col("_kind") == 0
    fwd = w.rangeBetween(1, horizon_days * US_PER_DAY)
    out = x.select("CustomerID", "invoice_month", F.col("InvoiceDate").alias("T"), "_kind", "_part", "_home",
                   F.count(F.when(is_ev, 1)).over(fwd).alias("_n"),
                   F.sum(F.when(is_ev, F.col("event_revenue"))).over(fwd).alias("_v"))
    out = out.filter((F.col("_kind") == 1) & (F.col("_part") == F.col("_home")))
    has_future = F.col("_n") > 0
    return out.select("CustomerID", "invoice_month", "T",
                      has_future.alias("has_future_purchase_90d"),
                      (~has_future).cast("int").alias("churn_90d"),
                      F.coalesce(F.col("_v"), F.lit(0.0)).alias("customer_value_90d"))


def add_censoring_flag(features: DataFrame, data_end, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """label_observed = the whole horizon lies inside the data (reference labels
    censored months as churned; this flag lets callers filter them)."""
    end = F.lit(data_end).cast("timestamp_ntz")
    return features.withColumn(
        "label_observed", F.col("T") + F.make_dt_interval(F.lit(horizon_days)) <= end)
