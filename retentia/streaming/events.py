"""Incremental event roll-up with Structured Streaming (optional extension; the
reference reads files whole). New transaction files are aggregated to the
(CustomerID, InvoiceDate) event grain with a watermark, so late lines within the
allowed lateness update their event and older state is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ntz_micros
from ..sources.paths import is_folder

EVENT_SOURCE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def purchase_stream(spark: SparkSession, table_path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Purchase events of the ``events`` table, a file or a folder of part files, read as
    a stream."""
    reader = (spark.readStream.schema(EVENT_SOURCE_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if is_folder(spark, table_path):
        s = reader.parquet(table_path)
    else:  # a stream's source is a folder: this file alone of its folder
        folder, _, name = table_path.rpartition("/")
        s = reader.option("pathGlobFilter", name).parquet(folder or ".")
    # the wall clock is read as UTC, so day windows do not depend on the session zone
    return (s.filter(F.col("event_type") == "purchase")
             .select(F.col("user_id").alias("CustomerID"),
                     F.timestamp_micros(ntz_micros("ts")).alias("InvoiceDate"),
                     F.col("value").alias("Revenue")))


def daily_event_rollup(stream: DataFrame, lateness: str | None = "2 days") -> DataFrame:
    """Per customer and day: revenue and event count so far. With a ``lateness``, state older
    than the watermark is dropped and lines that come later than that are left out;
    ``None`` keeps every day open, so the order of files does not matter."""
    timed = stream.withWatermark("InvoiceDate", lateness) if lateness else stream
    return (timed.groupBy("CustomerID", F.window("InvoiceDate", "1 day").alias("day"))
                  .agg(F.sum("Revenue").alias("event_revenue"), F.count(F.lit(1)).alias("n_events")))


def day_string(window_col: str = "day"):
    """'yyyy-MM-dd' of a day window's start, independent of the session zone."""
    days = F.floor(F.unix_micros(F.col(f"{window_col}.start")) / F.lit(86_400_000_000)).cast("int")
    return F.date_format(F.date_from_unix_date(days), "yyyy-MM-dd")


def keep_latest(df: DataFrame, table_path: str, checkpoint: str):
    """A query that writes each micro-batch's changed days under its batch number. A batch
    that is run again replaces its own folder, so every change is there once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    return (df.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint))


def latest(spark: SparkSession, table_path: str, keys: tuple[str, ...] = ("CustomerID", "day")) -> DataFrame:
    """The last written state of each key."""
    rows = spark.read.parquet(table_path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
            .select(*keys, "_v.*"))


def run_available(spark: SparkSession, df: DataFrame, table_path: str, checkpoint: str) -> DataFrame:
    """Drain everything available into the table at ``table_path`` and read it."""
    q = keep_latest(df, table_path, checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return latest(spark, table_path)
