"""Column-expression helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_DAY = 86_400_000_000


def ntz_micros(c: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (TIMESTAMP_NTZ) value.

    Built from date and time-of-day parts so it does not depend on the session
    time zone (casting NTZ to TIMESTAMP would)."""
    c = F.col(c) if isinstance(c, str) else c
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.date_part(F.lit("SECOND"), c)  # decimal(8,6) incl. fraction
    return (days * F.lit(US_PER_DAY)
            + F.hour(c).cast("long") * F.lit(3_600_000_000)
            + F.minute(c).cast("long") * F.lit(60_000_000)
            + (secs * F.lit(1_000_000)).cast("long"))


def floor_div(col_name: str, b: int) -> Column:
    """Exact integer floor division of a bigint column (negative-safe): the
    remainder is removed first, then SQL's integral ``div`` (no double rounding)."""
    return F.expr(f"(`{col_name}` - pmod(`{col_name}`, {int(b)}L)) div {int(b)}L")


def top_n(total: Column, k: float | Column) -> Column:
    """n = max(1, round_half_even(total * k)) -- the top-k size used everywhere."""
    k = k if isinstance(k, Column) else F.lit(float(k))
    return F.greatest(F.lit(1).cast("long"), F.bround(total.cast("double") * k, 0).cast("long"))


def check_budget(k: float) -> float:
    if not (0 < float(k) <= 1):
        raise ValueError("k must be in (0, 1].")
    return float(k)


def safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def month_str(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM")


def ts_str(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def budget_pct(k: Column) -> Column:
    """Integer percent for a budget fraction (rounded, not truncated)."""
    return F.round(k * F.lit(100.0)).cast("long")


def minmax_expr(c: Column, lo: float | None, hi: float | None) -> Column:
    """Scale with bounds computed beforehand; constant or empty column -> 0."""
    if lo is None or hi is None or hi <= lo:
        return F.lit(0.0)
    return (c.cast("double") - F.lit(float(lo))) / F.lit(float(hi) - float(lo))
