"""Registered queries: name -> (spark callable, DuckDB oracle SQL or None).

Every query reads the driver tables (or what Spark derives from them) in full;
outputs go through ``normalise`` so both engines print the same values."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as feat
from ..operators import grains, quality
from ..sources.tables import read_table, transactions
from . import oracles as O
from .common import features, normalise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: normalise(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


KEYS = ["CustomerID", "invoice_month"]


# ------------------------------------------------------------------ grains

@register("clean_transactions", O.with_base(
    f"SELECT Invoice, CustomerID, {O.ts('InvoiceDate')} AS InvoiceDate, {O.r4('Quantity')} AS Quantity, "
    f"{O.r4('Revenue')} AS Revenue FROM txr "
    "WHERE CustomerID IS NOT NULL AND InvoiceDate IS NOT NULL"))
def q_clean(spark, sf):
    # Price (extended / qty) often sits exactly on a 4-decimal half; engines break
    # that tie differently, so the check compares Revenue, which carries it.
    return grains.clean_transactions(transactions(spark, sf)).select(
        "Invoice", "CustomerID", "InvoiceDate", "Quantity", "Revenue")


@register("invoice_rollup", O.with_base(
    f"SELECT Invoice, CustomerID, {O.ts('InvoiceDate')} AS InvoiceDate, "
    f"{O.r4('invoice_total_revenue')} AS invoice_total_revenue, "
    f"{O.r4('invoice_total_quantity')} AS invoice_total_quantity, num_lines FROM inv"))
def q_invoice(spark, sf):
    return grains.invoice_rollup(transactions(spark, sf))


@register("customer_events", O.with_base(
    f"SELECT CustomerID, {O.ts('InvoiceDate')} AS InvoiceDate, {O.r4('event_revenue')} AS event_revenue, "
    f"{O.r4('event_quantity')} AS event_quantity, event_num_invoices, event_invoice_count FROM ev"))
def q_events(spark, sf):
    return grains.customer_events(grains.invoice_rollup(transactions(spark, sf)))


@register("customer_month", O.with_base(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {O.ts('T')} AS T FROM cm"))
def q_cm(spark, sf):
    return grains.customer_month(grains.invoice_rollup(transactions(spark, sf)))


# ------------------------------------------------------------------ features

def _ft_sql(cols: list[str]) -> str:
    out = [f"CustomerID", f"{O.month('invoice_month')} AS invoice_month"]
    for c in cols:
        if c in ("T", "prev_event_ts"):
            out.append(f"{O.ts(c)} AS {c}")
        elif c in ("churn_90d", "has_future_purchase_90d"):
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            out.append(f"{O.r4(c)} AS {c}")
    return O.with_base(f"SELECT {', '.join(out)} FROM ft")


def _ft_query(name: str, cols: list[str]):
    @register(name, _ft_sql(cols))
    def q(spark, sf):
        return features(spark, sf).select(*KEYS, *cols)
    return q


_ft_query("rolling_revenue", ["rev_sum_30d", "rev_sum_90d", "rev_sum_180d"])
_ft_query("rolling_frequency", ["freq_30d", "freq_90d"])
_ft_query("rolling_volatility", ["rev_std_90d"])
_ft_query("rolling_returns", ["return_count_90d"])
_ft_query("rolling_aov", ["aov_90d"])
_ft_query("recency_gap", ["T", "prev_event_ts", "gap_days_prev"])
_ft_query("feature_table", [c for c in feat.FEATURE_OUTPUT if c not in KEYS])


@register("churn_label", _ft_sql(["T", "has_future_purchase_90d", "churn_90d"]))
def q_label(spark, sf):
    """General (range) form: cut-off points mixed into bucketed forward frames."""
    inv = grains.invoice_rollup(transactions(spark, sf))
    ev = grains.customer_events(inv)
    return feat.label_at_points(grains.customer_month(inv), ev).select(
        *KEYS, "T", "has_future_purchase_90d", "churn_90d")


@register("future_value", _ft_sql(["T", "customer_value_90d"]))
def q_value(spark, sf):
    inv = grains.invoice_rollup(transactions(spark, sf))
    ev = grains.customer_events(inv)
    return feat.label_at_points(grains.customer_month(inv), ev).select(*KEYS, "T", "customer_value_90d")


@register("event_features", O.with_base(
    f"""SELECT e0.CustomerID, {O.ts('e0.InvoiceDate')} AS InvoiceDate,
      {O.r4(f"coalesce(sum(e.event_revenue) FILTER (WHERE e.us > e0.us - 30 * {O.D} AND e.us <= e0.us), 0)")} AS rev_sum_30d,
      {O.r4(f"coalesce(sum(e.event_revenue) FILTER (WHERE e.us > e0.us - 180 * {O.D} AND e.us <= e0.us), 0)")} AS rev_sum_180d,
      {O.r4(f"count(*) FILTER (WHERE e.us > e0.us - 90 * {O.D} AND e.us <= e0.us)")} AS freq_90d,
      {O.r4(f"stddev_samp(e.event_revenue) FILTER (WHERE e.us > e0.us - 90 * {O.D} AND e.us <= e0.us)")} AS rev_std_90d,
      {O.r4(f"coalesce((e0.us - max(e.us) FILTER (WHERE e.us < e0.us)) / {O.D}.0, 999.0)")} AS gap_days_prev,
      CAST(count(*) FILTER (WHERE e.us > e0.us AND e.us <= e0.us + 90 * {O.D}) > 0 AS BIGINT) AS has_future_purchase_90d
    FROM ev e0 JOIN ev e ON e.CustomerID = e0.CustomerID
    GROUP BY e0.CustomerID, e0.InvoiceDate, e0.us"""))
def q_event_features(spark, sf):
    ev = feat.event_features(grains.invoice_rollup(transactions(spark, sf)))
    return ev.select("CustomerID", "InvoiceDate", "rev_sum_30d", "rev_sum_180d", "freq_90d",
                     "rev_std_90d", "gap_days_prev", "has_future_purchase_90d")


# ------------------------------------------------------------------ checks

@register("null_rates", O.with_base(
    "SELECT " + ", ".join(f"{O.r4(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} AS {c}"
                          for c in ["prev_event_ts", "rev_std_90d", "gap_days_prev", "churn_90d"]) + " FROM ft"))
def q_null_rates(spark, sf):
    return quality.null_rates(features(spark, sf), ["prev_event_ts", "rev_std_90d", "gap_days_prev", "churn_90d"])


@register("duplicate_keys", O.with_base(
    f"SELECT CustomerID, {O.ts('InvoiceDate')} AS InvoiceDate, count(*) AS n_rows FROM inv "
    "GROUP BY CustomerID, InvoiceDate HAVING count(*) > 1"))
def q_dups(spark, sf):
    return quality.duplicate_keys(grains.invoice_rollup(transactions(spark, sf)), ["CustomerID", "InvoiceDate"])


@register("date_order_violations",
          "SELECT o_custkey, o_orderkey, o_orderdate, prev_date FROM ("
          f"SELECT o_custkey, o_orderkey, {O.ts('o_orderdate')} AS o_orderdate, "
          f"{O.ts('lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)')} AS prev_date, "
          "o_orderdate < lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS bad "
          "FROM orders) WHERE bad")
def q_date_order(spark, sf):
    od = read_table(spark, sf, "orders")
    return quality.date_order_violations(od, "o_custkey", "o_orderdate", "o_orderkey")


_ORDER_TEXT = " || chr(31) || ".join(
    f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in
    ("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"))


@register("table_fingerprint",
          "SELECT count(*) AS n_rows, bit_xor(('0x' || substr(h, 1, 8))::BIGINT) AS hash_xor, "
          "CAST(sum(('0x' || substr(h, 9, 8))::BIGINT) AS BIGINT) AS hash_sum "
          f"FROM (SELECT md5({_ORDER_TEXT}) AS h FROM orders)")
def q_fingerprint(spark, sf):
    return quality.table_fingerprint(read_table(spark, sf, "orders"))


@register("invoices_preaggregated", O.with_base(
    f"SELECT Invoice, CustomerID, {O.ts('InvoiceDate')} AS InvoiceDate, "
    f"{O.r4('invoice_total_revenue')} AS invoice_total_revenue, "
    f"{O.r4('invoice_total_quantity')} AS invoice_total_quantity, num_lines FROM inv"))
def q_invoices_fast(spark, sf):
    """Invoice grain with lineitem combined by order before the join."""
    from ..sources.tables import invoices
    return invoices(spark, sf)


_EV_COLS = ["T", "churn_90d", "rev_sum_30d", "freq_30d", "rev_std_90d", "gap_days_prev", "customer_value_90d"]


@register("event_source_features", O.with_events_base(
    "SELECT CustomerID, " + O.month("invoice_month") + " AS invoice_month, "
    + ", ".join(O.ts(c) + f" AS {c}" if c == "T" else (f"CAST({c} AS BIGINT) AS {c}" if c == "churn_90d"
                                                          else O.r4(c) + f" AS {c}") for c in _EV_COLS)
    + " FROM ft"))
def q_event_source(spark, sf):
    """The feature build over the second event source (purchase events with
    microsecond timestamps)."""
    from ..sources.tables import customer_month_events
    ft = feat.feature_table(grains.invoice_rollup(customer_month_events(spark, sf)))
    return ft.select(*KEYS, *_EV_COLS)
