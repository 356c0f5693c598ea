"""Shared building blocks of the registered queries: the standard scored table
and output normalisation (strings for dates, 4-decimal doubles)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PROJECT_DECISION, SplitConfig
from ..functions.columns import month_str, ts_str
from ..operators.features import feature_table
from ..operators.heuristics import add_heuristics, add_policy_scores, stub_probability
from ..operators.split import add_split
from ..session import cut_lineage
from ..sources.tables import invoices


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table from the invoice grain (pre-aggregated before the join)."""
    return feature_table(invoices(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str, split: SplitConfig | None = None) -> DataFrame:
    """Whole feature table -> heuristics -> stub probability -> policies -> split label.

    The feature table is cut once (reliable checkpoint): the heuristics need a few
    small aggregates and global ranks over it, and each would otherwise rebuild
    the features from the raw tables. The scored result is cut for the same
    reason before the evaluation steps rank it again."""
    ft = cut_lineage(features(spark, sf_dir))
    s = add_policy_scores(stub_probability(add_heuristics(ft)), PROJECT_DECISION)
    return cut_lineage(add_split(s, split or SplitConfig()))


def r4(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    # 1e-9 shift: exact decimal halves (common with 2-decimal money) would
    # otherwise round differently in different engines
    return F.round(c.cast("double") + F.lit(1e-9), 4) + F.lit(0.0)


def normalise(df: DataFrame) -> DataFrame:
    """Dates -> 'yyyy-MM', timestamps -> 'yyyy-MM-dd HH:mm:ss', doubles rounded to
    4 places, integers and booleans -> bigint. Keeps column names."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            out.append(month_str(c).alias(f.name))
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            out.append(ts_str(c).alias(f.name))
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(r4(c).alias(f.name))
        elif isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType)):
            out.append(c.cast("long").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
