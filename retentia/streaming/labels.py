"""Labels that arrive late (Q-28): predictions wait in a stream until it is known whether
their customer came back.

A prediction at T is joined with the customer's purchases in (T, T + horizon]. The join is a
stream-stream left outer join: a purchase that matches comes out at once, and a prediction
nobody answered comes out alone once the watermark has passed its horizon. Its state holds
one horizon of predictions and purchases, not the history.

The join key is the customer and a time slot as long as the horizon. A window covers two
slots at most, so a prediction is copied twice and a purchase never; a customer
with a third of all purchases is spread over the slots of its history. A purchase meets only
the customer's predictions of the horizon before it (three or four at one a month), so the
output grows with the purchases.

Predictions without customer or T are left out; one that repeats whole counts once. A purchase at T itself does
not answer, one at the very end of the horizon does. Rows later than the watermark are dropped
by the stream. The state's time bound is a day wider than the horizon, which keeps it safe
in session zones with clock changes; the label itself is compared in microseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ntz_micros
from ..sources.paths import is_folder

DAY_US = 86_400_000_000
WAIT_DAYS = 1  # the state's bound beyond the horizon


def instant(column: str) -> Column:
    """A zone-free timestamp read as UTC: streams need an instant as event time."""
    return F.timestamp_micros(ntz_micros(column))


def answers(predictions: DataFrame, purchases: DataFrame, horizon_days: int = 90,
            lateness: str = "2 days") -> DataFrame:
    """The stream of (prediction, ``answered``): one row a purchase inside the horizon, and rows
    with a null once the horizon has passed. ``predictions`` has CustomerID and T (an instant) and
    any other columns, ``purchases`` CustomerID and InvoiceDate (an instant)."""
    size = horizon_days * DAY_US

    def slot(c: str) -> Column:
        return F.floor(F.unix_micros(F.col(c)) / F.lit(size)).cast("long")

    asked = (predictions.filter("CustomerID IS NOT NULL AND T IS NOT NULL").withWatermark("T", lateness)
             .withColumn("_slot", F.explode(F.array(slot("T"), slot("T") + 1))))
    came = purchases.withWatermark("InvoiceDate", lateness).select(
        F.col("CustomerID").alias("_id"), slot("InvoiceDate").alias("_at"), F.col("InvoiceDate").alias("answered"))
    until = F.col("T") + F.expr(f"INTERVAL {horizon_days + WAIT_DAYS} DAYS")
    exact = F.unix_micros("answered") - F.unix_micros("T") <= F.lit(size)
    return asked.join(came, (F.col("CustomerID") == F.col("_id")) & (F.col("_slot") == F.col("_at"))
                      & (F.col("answered") > F.col("T")) & (F.col("answered") <= until) & exact,
                      "left_outer").drop("_slot", "_id", "_at")


def drain(spark: SparkSession, stream: DataFrame, table_path: str, checkpoint: str) -> None:
    """Process what is there, append the answers to ``table_path`` and note the watermark beside them.
    A run that dies is continued from the checkpoint; the file sink keeps each batch once."""
    q = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{table_path}/answers")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    marks = [p["eventTime"]["watermark"] for p in q.recentProgress if "watermark" in p["eventTime"]]
    if marks:  # ISO instants in UTC: their order is that of the text
        (spark.createDataFrame([(max(marks),)], "watermark string").coalesce(1)
         .write.mode("append").parquet(f"{table_path}/watermarks"))


def watermark(spark: SparkSession, table_path: str) -> Column:
    """The furthest watermark noted, in microseconds; null before any data came."""
    path = f"{table_path}/watermarks"
    mark = spark.read.parquet(path).agg(F.max("watermark")).first()[0] if is_folder(spark, path) else None
    # the offset is part of the text, so the session zone has no say
    return F.unix_micros(F.lit(mark).cast("timestamp")) if mark else F.lit(None).cast("long")


def labels(spark: SparkSession, table_path: str, horizon_days: int = 90) -> DataFrame:
    """One row a prediction that came out: its columns, ``first_return`` and ``churned`` (1: nobody
    came back, 0: somebody did), and ``closed``: whether the watermark has passed its horizon. An open
    prediction is here only if it was answered early, so rates are taken over closed ones."""
    rows = spark.read.parquet(f"{table_path}/answers")
    keys = [c for c in rows.columns if c != "answered"]
    out = rows.groupBy(*keys).agg(F.min("answered").alias("first_return"))
    passed = F.unix_micros("T") + F.lit((horizon_days + WAIT_DAYS) * DAY_US) < watermark(spark, table_path)
    return (out.withColumn("churned", F.col("first_return").isNull().cast("int"))
            .withColumn("closed", F.coalesce(passed, F.lit(False))))


def label_report(spark: SparkSession, table_path: str, horizon_days: int = 90, period: str = "month",
                 score: str = "churn_prob") -> DataFrame:
    """How the predictions of each period (``month``, ``week`` or ``day`` of T, UTC) turned out: only periods
    whose last instant is closed, so that no period shows its early answers alone. Columns: period, n_predictions,
    n_churned, churn_rate, mean_score, calibration_gap (mean score less churn rate), brier_score and
    mean_days_to_return (null if nobody came back). Scores that are null are left out of their means."""
    made = labels(spark, table_path, horizon_days)
    day = F.date_from_unix_date(F.floor(F.unix_micros("T") / F.lit(DAY_US)).cast("int"))
    start = day if period == "day" else F.trunc(day, period).cast("date")
    following = {"month": F.add_months("period", 1), "week": F.date_add("period", 7),
                 "day": F.date_add("period", 1)}[period]
    away = (F.unix_micros("first_return") - F.unix_micros("T")) / F.lit(DAY_US)
    error = F.col(score) - F.col("churned")
    out = made.withColumn("period", start).groupBy("period").agg(
        F.count(F.lit(1)).alias("n_predictions"), F.sum("churned").alias("n_churned"),
        F.avg("churned").alias("churn_rate"), F.avg(score).alias("mean_score"),
        F.avg(error).alias("calibration_gap"), F.avg(error * error).alias("brier_score"),
        F.avg(away).alias("mean_days_to_return"))
    end = F.unix_date(following).cast("long") * F.lit(DAY_US) + F.lit((horizon_days + WAIT_DAYS) * DAY_US)
    return out.filter(end <= watermark(spark, table_path))
