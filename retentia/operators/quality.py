"""Table checks (O-12..O-16): schema checks cost nothing; data checks are one
aggregate each, never a collect of data-sized frames."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import is_numeric


def require_columns(df: DataFrame, required: Iterable[str], name: str) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{name} lacks columns {missing}")


def null_rates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row, one ``<col>`` null-rate column per input column (single pass)."""
    cols = list(columns)
    return df.agg(*[F.coalesce(F.avg(F.col(f"`{c}`").isNull().cast("double")), F.lit(0.0))
                    .alias(c) for c in cols])


def validate_null_thresholds(df: DataFrame, thresholds: dict[str, float], name: str) -> None:
    present = {c: t for c, t in thresholds.items() if c in df.columns}
    if not present:
        return
    row = null_rates(df, present).first()
    for c, t in present.items():
        rate = float(row[c])
        if rate > float(t):
            raise ValueError(f"{name}: {rate:.3f} of {c} is null, at most {float(t):.3f} may be")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation first)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def validate_unique_keys(df: DataFrame, keys: list[str], name: str) -> None:
    require_columns(df, keys, name)
    if duplicate_keys(df, keys).limit(1).count() > 0:
        raise ValueError(f"{name}: several rows share {keys}")


def date_order_violations(df: DataFrame, group_col: str, date_col: str, seq_col: str) -> DataFrame:
    """Rows whose date is earlier than the previous row's date within the group,
    where 'previous' follows an explicit sequence column (the reference sorted by
    the date first, so its check could never fail)."""
    w = Window.partitionBy(group_col).orderBy(seq_col)
    return (df.select(group_col, seq_col, date_col,
                      F.lag(date_col).over(w).alias("prev_date"))
            .filter(F.col(date_col) < F.col("prev_date")))


def validate_date_order(df: DataFrame, group_col: str, date_col: str, name: str,
                        seq_col: str | None = None) -> None:
    require_columns(df, [group_col, date_col], name)
    if seq_col is None:
        return  # without a sequence column the order is not observable
    if date_order_violations(df, group_col, date_col, seq_col).limit(1).count() > 0:
        raise ValueError(f"{name}: {date_col} goes back within a {group_col}")


def validate_inference_frame(df: DataFrame, feature_cols: list[str]) -> None:
    missing = [c for c in feature_cols if c not in df.columns]
    if missing:
        raise ValueError(f"features to score lack columns {missing}")
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    non_numeric = [c for c in feature_cols if not is_numeric(types[c])]
    if non_numeric:
        raise TypeError(f"features to score are not numbers: {non_numeric}")


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive data version of a table: row count and two folds of the first and
    next 32 bits of each row's md5, over its columns as text in name order (null as an
    unprintable mark), so any engine can recompute it."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in sorted(df.columns)]
    h = F.md5(F.concat_ws("\x1f", *parts))
    words = [F.conv(F.substring(h, at, 8), 16, 10).cast("long") for at in (1, 9)]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(words[0]).alias("hash_xor"),
                  F.sum(words[1]).alias("hash_sum"))
