"""Independent DuckDB SQL for every SQL-checkable registered query.

These are written in the join form (every cut-off row joined to all of its
customer's events, then filtered), so they share no logic with the Spark
window plans they check."""

from __future__ import annotations

D = "86400000000"


def r4(x: str) -> str:
    """4-decimal canonical form; the 1e-9 shift moves exact decimal halves off the
    rounding boundary so both engines agree (the Spark side does the same)."""
    return f"(round(CAST({x} AS DOUBLE) + 1e-9, 4) + 0.0)"


def month(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


TX = """tx AS (
  SELECT o.o_orderkey AS Invoice, o.o_custkey AS CustomerID, o.o_orderdate AS InvoiceDate,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS DOUBLE) AS Quantity,
         l.l_extendedprice / l.l_quantity AS Price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
txr AS (SELECT *, Quantity * Price AS Revenue FROM tx)"""

INV = """inv AS (
  SELECT Invoice, CustomerID, min(InvoiceDate) AS InvoiceDate, sum(Revenue) AS invoice_total_revenue,
         sum(Quantity) AS invoice_total_quantity, count(*) AS num_lines
  FROM txr WHERE Invoice IS NOT NULL AND CustomerID IS NOT NULL GROUP BY Invoice, CustomerID)"""

EV = """ev AS (
  SELECT CustomerID, InvoiceDate, epoch_us(InvoiceDate) AS us, sum(invoice_total_revenue) AS event_revenue,
         sum(invoice_total_quantity) AS event_quantity, CAST(sum(num_lines) AS BIGINT) AS event_num_invoices,
         count(*) AS event_invoice_count
  FROM inv GROUP BY CustomerID, InvoiceDate)"""

CM = """cm AS (
  SELECT CustomerID, date_trunc('month', InvoiceDate) AS invoice_month, max(InvoiceDate) AS T,
         epoch_us(max(InvoiceDate)) AS t_us
  FROM inv GROUP BY 1, 2)"""


def _in(lo: str, hi: str) -> str:
    return f"FILTER (WHERE e.us > {lo} AND e.us <= {hi})"


FT = f"""ft AS (
  SELECT cm.CustomerID, cm.invoice_month, cm.T,
    count(*) {_in('cm.t_us', f'cm.t_us + 90 * {D}')} > 0 AS has_future_purchase_90d,
    CASE WHEN count(*) {_in('cm.t_us', f'cm.t_us + 90 * {D}')} > 0 THEN 0 ELSE 1 END AS churn_90d,
    coalesce(sum(e.event_revenue) {_in(f'cm.t_us - 30 * {D}', 'cm.t_us')}, 0.0) AS rev_sum_30d,
    coalesce(sum(e.event_revenue) {_in(f'cm.t_us - 90 * {D}', 'cm.t_us')}, 0.0) AS rev_sum_90d,
    coalesce(sum(e.event_revenue) {_in(f'cm.t_us - 180 * {D}', 'cm.t_us')}, 0.0) AS rev_sum_180d,
    CAST(count(*) {_in(f'cm.t_us - 30 * {D}', 'cm.t_us')} AS DOUBLE) AS freq_30d,
    CAST(count(*) {_in(f'cm.t_us - 90 * {D}', 'cm.t_us')} AS DOUBLE) AS freq_90d,
    coalesce(stddev_samp(e.event_revenue) {_in(f'cm.t_us - 90 * {D}', 'cm.t_us')}, 0.0) AS rev_std_90d,
    CAST(count(*) FILTER (WHERE e.us > cm.t_us - 90 * {D} AND e.us <= cm.t_us AND e.event_revenue < 0) AS DOUBLE)
      AS return_count_90d,
    coalesce(avg(e.event_revenue) {_in(f'cm.t_us - 90 * {D}', 'cm.t_us')}, 0.0) AS aov_90d,
    max(e.InvoiceDate) FILTER (WHERE e.us < cm.t_us) AS prev_event_ts,
    coalesce((cm.t_us - max(e.us) FILTER (WHERE e.us < cm.t_us)) / {D}.0, 999.0) AS gap_days_prev,
    coalesce(sum(e.event_revenue) {_in('cm.t_us', f'cm.t_us + 90 * {D}')}, 0.0) AS customer_value_90d
  FROM cm JOIN ev e ON e.CustomerID = cm.CustomerID
  GROUP BY cm.CustomerID, cm.invoice_month, cm.T, cm.t_us)"""

BASE = ",\n".join([TX, INV, EV, CM, FT])


def with_base(select: str, *extra_ctes: str) -> str:
    ctes = ",\n".join([BASE, *extra_ctes])
    return f"WITH {ctes}\n{select}"


# scored table: heuristics, stub probability, project decision config, split label
SCORED = f"""sc0 AS (
  SELECT ft.*, greatest(rev_sum_90d, 0.0) AS value_pos,
         least(greatest(rev_sum_90d / 500000.0, 0.0), 1.0) AS churn_prob
  FROM ft),
rk AS (
  SELECT sc0.*,
    rank() OVER (ORDER BY gap_days_prev) + (count(*) OVER (PARTITION BY gap_days_prev) - 1) / 2.0 AS r_rank,
    rank() OVER (ORDER BY freq_90d DESC) + (count(*) OVER (PARTITION BY freq_90d) - 1) / 2.0 AS f_rank,
    rank() OVER (ORDER BY rev_sum_90d DESC) + (count(*) OVER (PARTITION BY rev_sum_90d) - 1) / 2.0 AS m_rank
  FROM sc0),
bnd AS (
  SELECT min(gap_days_prev) AS g0, max(gap_days_prev) AS g1, min(freq_90d) AS q0, max(freq_90d) AS q1,
         min(value_pos) AS v0, max(value_pos) AS v1, min(r_rank) AS r0, max(r_rank) AS r1,
         min(f_rank) AS f0, max(f_rank) AS f1, min(m_rank) AS m0, max(m_rank) AS m1
  FROM rk),
sc1 AS (
  SELECT rk.*,
    CASE WHEN g1 > g0 THEN (gap_days_prev - g0) / (g1 - g0) ELSE 0.0 END AS recency_risk,
    ((CASE WHEN r1 > r0 THEN (r_rank - r0) / (r1 - r0) ELSE 0.0 END)
     + (1.0 - CASE WHEN f1 > f0 THEN (f_rank - f0) / (f1 - f0) ELSE 0.0 END)
     + (1.0 - CASE WHEN m1 > m0 THEN (m_rank - m0) / (m1 - m0) ELSE 0.0 END)) / 3.0 AS rfm_risk,
    CASE WHEN q1 > q0 THEN (freq_90d - q0) / (q1 - q0) ELSE 0.0 END AS _fs,
    CASE WHEN v1 > v0 THEN (value_pos - v0) / (v1 - v0) ELSE 0.0 END AS _vs
  FROM rk, bnd),
sc2 AS (
  SELECT sc1.*,
    0.15 * least(greatest(1.0 + 0.45 * recency_risk - 0.20 * _fs, 0.70), 1.40) AS assumed_success_rate_customer,
    15.0 * least(greatest(1.0 + 0.35 * _vs + 0.15 * _fs, 0.85), 1.35) AS intervention_cost_customer
  FROM sc1),
sc AS (
  SELECT sc2.*,
    churn_prob * value_pos AS policy_ml,
    churn_prob * value_pos * assumed_success_rate_customer * 1.0 AS expected_retained_value,
    intervention_cost_customer AS expected_cost,
    churn_prob * value_pos * assumed_success_rate_customer * 1.0 - intervention_cost_customer AS policy_net_benefit,
    recency_risk * value_pos AS policy_recency,
    rfm_risk * value_pos AS policy_rfm,
    CASE WHEN invoice_month <= DATE '1999-12-01' THEN 'train'
         WHEN invoice_month >= DATE '2000-01-01' AND invoice_month <= DATE '2000-06-01' THEN 'val'
         WHEN invoice_month >= DATE '2000-07-01' AND invoice_month <= DATE '2001-04-01' THEN 'test' END AS split
  FROM sc2)"""


def with_scored(select: str, *extra_ctes: str) -> str:
    return with_base(select, SCORED, *extra_ctes)


def topn(total: str, k: str) -> str:
    return f"greatest(1, CAST(round_even(CAST({total} AS DOUBLE) * {k}, 0) AS BIGINT))"


def rank_expr(policy: str, partition: str = "") -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    return (f"row_number() OVER ({part}ORDER BY round({policy}, 6) DESC NULLS LAST, "
            f"CustomerID, invoice_month)")


EVENTS_TX = """tx AS (
  SELECT event_id AS Invoice, user_id AS CustomerID, ts AS InvoiceDate, 1.0 AS Quantity, value AS Price
  FROM events WHERE event_type = 'purchase'),
txr AS (SELECT *, Price AS Revenue FROM tx)"""


def with_events_base(select: str) -> str:
    """Same feature CTEs over the purchase events (microsecond timestamps)."""
    return "WITH " + ",\n".join([EVENTS_TX, INV, EV, CM, FT]) + "\n" + select
