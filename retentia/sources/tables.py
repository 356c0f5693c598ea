"""Scans: driver parquet tables, the transaction-line view, raw CSV."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import exists
from ..schemas import RAW_SCHEMA

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines from the driver tables (one row per lineitem).

    CustomerID = o_custkey, Invoice = o_orderkey, InvoiceDate = o_orderdate,
    Quantity = l_quantity (negated for returned lines), Price = extended / qty,
    Revenue = Quantity * Price. Only the five needed columns are scanned.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    qty = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
            .select(F.col("o_orderkey").alias("Invoice"),
                    F.col("o_custkey").alias("CustomerID"),
                    F.col("o_orderdate").alias("InvoiceDate"),
                    qty.cast("double").alias("Quantity"),
                    price.cast("double").alias("Price"))
            .withColumn("Revenue", F.col("Quantity") * F.col("Price")))


def load_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw transaction CSV (Latin-1, header), every column read as string.
    A missing path is an error, as in the reference."""
    if not exists(spark, path):
        raise FileNotFoundError(f"Raw CSV not found: {path}")
    return (spark.read.schema(RAW_SCHEMA).option("header", True)
            .option("encoding", "ISO-8859-1").option("mode", "PERMISSIVE").csv(path))


def customer_month_events(spark: SparkSession, sf_dir: str,
                          event_type: str = "purchase") -> DataFrame:
    """Second event source: the ``events`` table as transactions
    (user_id -> CustomerID, ts -> InvoiceDate, value -> Revenue, one line per event)."""
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type") == event_type)
    return ev.select(F.col("event_id").alias("Invoice"),
                     F.col("user_id").alias("CustomerID"),
                     F.col("ts").alias("InvoiceDate"),
                     F.lit(1.0).alias("Quantity"),
                     F.col("value").alias("Price"),
                     F.col("value").alias("Revenue"))


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice grain straight from the driver tables, aggregated *before* the join:
    lineitem is combined map-side by order key, so the join shuffles one row per
    order instead of one per line. Same result as invoice_rollup(transactions()):
    an order has one customer and one date, so min(date) is the order date."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    qty = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("double")
    price = (F.col("l_extendedprice") / F.col("l_quantity")).cast("double")
    per_order = (li.select("l_orderkey", qty.alias("q"), (qty * price).alias("r"))
                   .groupBy("l_orderkey")
                   .agg(F.sum("r").alias("invoice_total_revenue"), F.sum("q").alias("invoice_total_quantity"),
                        F.count(F.lit(1)).alias("num_lines")))
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = per_order.join(od, per_order.l_orderkey == od.o_orderkey, "inner")
    return (j.filter(F.col("o_custkey").isNotNull())
             .select(F.col("o_orderkey").alias("Invoice"), F.col("o_custkey").alias("CustomerID"),
                     F.col("o_orderdate").alias("InvoiceDate"), "invoice_total_revenue",
                     "invoice_total_quantity", "num_lines"))
