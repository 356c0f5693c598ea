"""Registered endpoint-style queries over the scored table and a streaming
roll-up of the events table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators import compare as C
from ..operators import evaluate as EV
from ..operators.grains import customer_events
from ..session import ensure_checkpoint_dir
from ..sources.tables import invoices, read_table
from ..streaming import labels as SL
from ..streaming.events import daily_event_rollup, day_string, purchase_stream, run_available
from . import oracles as O
from . import registry_decisions as REG_DEC
from . import tables as TB
from .common import features, scored
from .registry import KEYS, register

R4 = O.r4


@register("point_lookup", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {R4('churn_prob')} AS churn_prob, "
    f"{R4('policy_net_benefit')} AS policy_net_benefit FROM sc "
    "ORDER BY round(policy_net_benefit, 6) DESC, CustomerID, invoice_month LIMIT 1"))
def q_lookup(spark, sf):
    """Lookup of one customer-month (the one the table ranks first), with
    predicate pushdown on the key."""
    s = scored(spark, sf)
    best = TB.top_predictions(s, "policy_net_benefit", 1).select("CustomerID", "invoice_month").first()
    month = best["invoice_month"].strftime("%Y-%m")
    return TB.lookup_prediction(s, best["CustomerID"], month).select(*KEYS, "churn_prob", "policy_net_benefit")


@register("id_substring_targets", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {R4('policy_net_benefit')} AS policy_net_benefit "
    f"FROM (SELECT *, {O.rank_expr('policy_net_benefit')} AS r, count(*) OVER () AS n FROM sc) "
    f"WHERE CAST(CustomerID AS VARCHAR) LIKE '%7%' AND r <= {O.topn('n', '0.10')}"))
def q_substring(spark, sf):
    from ..operators.selection import target_flags
    s = target_flags(scored(spark, sf), "policy_net_benefit", [0.10], digits=6)
    return TB.explorer(s, "7", True, "target_k10").select(*KEYS, "policy_net_benefit")


@register("free_text_filter", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {O.ts('T')} AS T, churn_90d "
    "FROM sc WHERE strftime(invoice_month, '%Y-%m-%d') LIKE '%1999-12%' OR strftime(T, '%Y-%m-%d %H:%M:%S') LIKE '%1999-12%'"))
def q_free_text(spark, sf):
    s = scored(spark, sf).select(*KEYS, "T", "churn_90d")
    return TB.free_text_filter(s, "1999-12")


@register("top_predictions", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {R4('policy_net_benefit')} AS policy_net_benefit, "
    f"{R4('churn_prob')} AS churn_prob FROM sc ORDER BY policy_net_benefit DESC, CustomerID, invoice_month LIMIT 50"))
def q_top(spark, sf):
    return TB.top_predictions(scored(spark, sf), "policy_net_benefit", 50).select(
        *KEYS, "policy_net_benefit", "churn_prob")


@register("top_predictions_total", O.with_scored(
    f"SELECT CustomerID, {O.month('invoice_month')} AS invoice_month, {R4('policy_net_benefit')} AS policy_net_benefit, "
    "(SELECT count(*) FROM sc) AS total_count FROM sc ORDER BY sc.policy_net_benefit DESC, CustomerID, sc.invoice_month LIMIT 20"))
def q_top_total(spark, sf):
    return TB.top_predictions(scored(spark, sf), "policy_net_benefit", 20, total=True).select(
        *KEYS, "policy_net_benefit", "total_count")


@register("kpis", O.with_scored(
    f"SELECT count(*) AS rows_scored, {R4('avg(churn_prob)')} AS mean_churn_prob FROM sc"))
def q_kpis(spark, sf):
    return TB.kpis(scored(spark, sf))


_SEG_NB = """segt2 AS (SELECT * FROM seg WHERE split = 'test'),
snb AS (SELECT segment_type, segment_value, policy, sum(policy_net_benefit) AS nb FROM (
          SELECT segment_type, segment_value, policy_net_benefit, 'policy_ml' AS policy,
                 row_number() OVER (PARTITION BY segment_type, segment_value ORDER BY round(policy_ml, 6) DESC NULLS LAST,
                                    CustomerID, invoice_month) AS r,
                 count(*) OVER (PARTITION BY segment_type, segment_value) AS n FROM segt2
          UNION ALL
          SELECT segment_type, segment_value, policy_net_benefit, 'policy_net_benefit' AS policy,
                 row_number() OVER (PARTITION BY segment_type, segment_value ORDER BY round(policy_net_benefit, 6) DESC NULLS LAST,
                                    CustomerID, invoice_month) AS r,
                 count(*) OVER (PARTITION BY segment_type, segment_value) AS n FROM segt2)
        WHERE r <= greatest(1, CAST(round_even(CAST(n AS DOUBLE) * 0.10, 0) AS BIGINT))
        GROUP BY segment_type, segment_value, policy)"""


@register("segment_contribution", O.with_scored(
    f"""SELECT c.segment_type, c.segment_value, {R4('0.10')} AS budget_k, {R4('c.nb')} AS net_benefit_at_k,
        {R4('coalesce(c.nb - b.nb, 0.0)')} AS delta_vs_baseline,
        {R4('CASE WHEN t.pos > 0 THEN greatest(c.nb, 0.0) / t.pos ELSE 0.0 END')} AS contribution_share,
        CAST(c.nb < 0 AS BIGINT) AS negative_roi
      FROM (SELECT * FROM snb WHERE policy = 'policy_net_benefit') c
      LEFT JOIN (SELECT * FROM snb WHERE policy = 'policy_ml') b USING (segment_type, segment_value)
      JOIN (SELECT segment_type, sum(greatest(nb, 0.0)) AS pos FROM snb WHERE policy = 'policy_net_benefit'
            GROUP BY segment_type) t USING (segment_type)""",
    REG_DEC.SEG_SQL, _SEG_NB))
def q_seg_contrib(spark, sf):
    """Segment share of positive net benefit and delta vs policy_ml (both
    policies' segment rows at 10 %)."""
    s = scored(spark, sf).filter(F.col("split") == "test")
    long = EV.segment_long(s)
    g = ["segment_type", "segment_value"]
    rows = EV.policy_metrics(long, [0.10], ["policy_ml", "policy_net_benefit"], g, include_random=False)
    return C.segment_contribution(rows)


@register("streaming_purchase_rollup",
          f"SELECT user_id AS CustomerID, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, "
          f"{R4('sum(value)')} AS event_revenue, count(*) AS n_events FROM events "
          "WHERE event_type = 'purchase' GROUP BY 1, 2")
def q_stream(spark, sf):
    """Structured Streaming: purchase events rolled up per customer and day."""
    folder = f"{ensure_checkpoint_dir(spark)}/stream-{os.urandom(4).hex()}"
    rollup = daily_event_rollup(purchase_stream(spark, f"{sf}/events.parquet"), lateness=None)
    out = run_available(spark, rollup, f"{folder}/table", f"{folder}/checkpoint")
    return out.select("CustomerID", day_string("day").alias("day"), "event_revenue", "n_events")


def _delayed(spark, predictions, purchases, horizon_days):
    """Predictions and purchases written as the jobs write them, then streamed from those folders."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/delayed-{os.urandom(4).hex()}"
    streams = []
    for name, rows in (("predictions", predictions), ("purchases", purchases)):
        rows.write.parquet(f"{folder}/{name}")
        streams.append(spark.readStream.schema(spark.read.parquet(f"{folder}/{name}").schema)
                       .parquet(f"{folder}/{name}"))
    SL.drain(spark, SL.answers(*streams, horizon_days), f"{folder}/labels", f"{folder}/checkpoint")
    return f"{folder}/labels"


@register("delayed_label_report", O.with_base(
    f"""SELECT {O.month('invoice_month')} AS period, count(*) AS n_predictions,
          CAST(sum(churned) AS BIGINT) AS n_churned,
          {R4('avg(churned)')} AS churn_rate, {R4('avg(p)')} AS mean_score, {R4('avg(p - churned)')} AS calibration_gap,
          {R4('avg((p - churned) * (p - churned))')} AS brier_score, {R4('avg(away)')} AS mean_days_to_return
        FROM (SELECT cm.invoice_month, 1.0 / (1.0 + min(ft.freq_90d)) AS p,
                CASE WHEN min(e.us) IS NULL THEN 1 ELSE 0 END AS churned,
                (min(e.us) - cm.t_us) / {O.D}.0 AS away
              FROM cm JOIN ft USING (CustomerID, invoice_month)
              LEFT JOIN ev e ON e.CustomerID = cm.CustomerID AND e.us > cm.t_us AND e.us <= cm.t_us + 90 * {O.D}
              GROUP BY cm.CustomerID, cm.invoice_month, cm.t_us)
        WHERE invoice_month + INTERVAL 1 MONTH + INTERVAL 91 DAY <= (SELECT max(InvoiceDate) FROM ev) - INTERVAL 2 DAY
        GROUP BY invoice_month"""))
def q_delayed_report(spark, sf):
    """Q-28: customer-month predictions (score 1 / (1 + purchases of 90 days)) and the purchases that came later, as
    streams: churn, calibration and Brier score of each month whose 90 days have passed."""
    grain = invoices(spark, sf)
    asked = features(spark, sf).select("CustomerID", SL.instant("T").alias("T"),
                                       (1.0 / (1.0 + F.col("freq_90d"))).alias("churn_prob"))
    came = customer_events(grain).select("CustomerID", SL.instant("InvoiceDate").alias("InvoiceDate"))
    return SL.label_report(spark, _delayed(spark, asked, came, 90))


@register("delayed_labels_events",
          f"""WITH b AS (SELECT user_id AS CustomerID, epoch_us(ts) AS us, value FROM events
                  WHERE event_type = 'purchase'),
                p AS (SELECT CustomerID, max(us) AS t_us, sum(value) AS v FROM b GROUP BY CustomerID, us // {O.D})
              SELECT p.CustomerID, p.t_us, {R4('1.0 / (1.0 + min(p.v))')} AS churn_prob, {R4(f'(min(b.us) - p.t_us) / {O.D}.0')} AS days_to_return,
                CASE WHEN min(b.us) IS NULL THEN 1 ELSE 0 END AS churned
              FROM p LEFT JOIN b ON b.CustomerID = p.CustomerID AND b.us > p.t_us AND b.us <= p.t_us + 7 * {O.D}
              WHERE p.t_us + 8 * {O.D} < (SELECT max(us) FROM b) - 2 * {O.D}
              GROUP BY p.CustomerID, p.t_us""")
def q_delayed_events(spark, sf):
    """Q-28 on the ``events`` table: one prediction a customer and day of purchase, labelled by the seven days after."""
    bought = read_table(spark, sf, "events").filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("CustomerID"), SL.instant("ts").alias("InvoiceDate"), F.col("value").alias("Revenue"))
    day = F.floor(F.unix_micros("InvoiceDate") / F.lit(SL.DAY_US))
    asked = (bought.groupBy("CustomerID", day.alias("_d")).agg(F.max("InvoiceDate").alias("T"), F.sum("Revenue").alias("v"))
             .select("CustomerID", "T", (1.0 / (1.0 + F.col("v"))).alias("churn_prob")))
    made = SL.labels(spark, _delayed(spark, asked, bought.select("CustomerID", "InvoiceDate"), 7), 7)
    away = (F.unix_micros("first_return") - F.unix_micros("T")) / F.lit(SL.DAY_US)
    return made.filter("closed").select("CustomerID", F.unix_micros("T").alias("t_us"), "churn_prob",
                                        away.alias("days_to_return"), "churned")
