"""Cleaning and the three roll-up grains (O-17, O-28..O-31)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import require_columns


def _as_double(c: str, dtype: T.DataType):
    if isinstance(dtype, T.StringType):
        return F.expr(f"try_cast(trim(`{c}`) AS DOUBLE)")
    return F.col(f"`{c}`").cast("double")


def clean_transactions(df: DataFrame) -> DataFrame:
    """Raw lines -> typed lines with Revenue; bad dates / numbers become null and
    those rows are dropped. Duplicates, zero prices and returns are kept."""
    cols = set(df.columns)
    if "InvoiceDate" not in cols:
        raise ValueError("the raw table has no InvoiceDate")
    if "CustomerID" not in cols and "Customer ID" not in cols:
        raise ValueError("the raw table has no customer column (Customer ID or CustomerID)")
    for c in ("Quantity", "Price"):
        if c not in cols:
            raise ValueError(f"the raw table has no {c}")
    types = {f.name: f.dataType for f in df.schema.fields}
    id_src = "CustomerID" if "CustomerID" in cols else "Customer ID"

    if isinstance(types["InvoiceDate"], T.StringType):
        date = F.coalesce(
            F.try_to_timestamp(F.col("InvoiceDate"), F.lit("yyyy-MM-dd HH:mm:ss")),
            F.try_to_timestamp(F.col("InvoiceDate"), F.lit("yyyy-MM-dd HH:mm")),
            F.try_to_timestamp(F.col("InvoiceDate"), F.lit("M/d/yyyy H:mm")),
            F.try_to_timestamp(F.col("InvoiceDate"), F.lit("yyyy-MM-dd")),
        ).cast("timestamp_ntz")
    else:
        date = F.col("InvoiceDate").cast("timestamp_ntz")
    cid = _as_double(id_src, types[id_src]).cast("long")
    qty = _as_double("Quantity", types["Quantity"])
    price = _as_double("Price", types["Price"])

    keep = [c for c in df.columns if c not in ("InvoiceDate", "Quantity", "Price", "CustomerID", "Revenue")]
    out = df.select(*[F.col(f"`{c}`") for c in keep],
                    date.alias("InvoiceDate"), cid.alias("CustomerID"),
                    qty.alias("Quantity"), price.alias("Price"))
    return (out.withColumn("Revenue", F.col("Quantity") * F.col("Price"))
            .dropna(subset=["CustomerID", "InvoiceDate", "Quantity", "Price"]))


def invoice_rollup(tx: DataFrame) -> DataFrame:
    """(Invoice, CustomerID) grain: first timestamp, revenue, quantity, line count."""
    require_columns(tx, ["Invoice", "InvoiceDate", "CustomerID", "Quantity", "Revenue"], "transactions")
    return (tx.dropna(subset=["Invoice", "CustomerID"])
            .groupBy("Invoice", "CustomerID")
            .agg(F.min("InvoiceDate").alias("InvoiceDate"),
                 F.sum("Revenue").alias("invoice_total_revenue"),
                 F.sum("Quantity").alias("invoice_total_quantity"),
                 F.count(F.lit(1)).alias("num_lines")))


def customer_events(invoices: DataFrame) -> DataFrame:
    """(CustomerID, InvoiceDate) grain. Note the reference's names:
    event_num_invoices sums line counts, event_invoice_count counts invoices."""
    return (invoices.groupBy("CustomerID", "InvoiceDate")
            .agg(F.sum("invoice_total_revenue").alias("event_revenue"),
                 F.sum("invoice_total_quantity").alias("event_quantity"),
                 F.sum("num_lines").alias("event_num_invoices"),
                 F.count(F.lit(1)).alias("event_invoice_count")))


def add_invoice_month(df: DataFrame, ts_col: str = "InvoiceDate") -> DataFrame:
    return df.withColumn("invoice_month", F.trunc(F.col(ts_col).cast("date"), "MM"))


def customer_month(invoices: DataFrame) -> DataFrame:
    """(CustomerID, invoice_month) grain with T = last event timestamp of the month."""
    return (add_invoice_month(invoices)
            .groupBy("CustomerID", "invoice_month")
            .agg(F.max("InvoiceDate").alias("T")))
