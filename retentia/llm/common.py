"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.session import ensure_checkpoint_dir
from retentia.sources.paths import hadoop

# Folders of the tables written so far by the innermost ``distilled``.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors all see."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: later plans start from
    the files, and their size is known to the planner when it picks joins."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    if (passing := _PASSING.get()) is not None:
        passing.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def distilled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``written`` of the table that ``make`` gives. Tables written on the way to it are deleted: no
    later plan may read them, so ``make`` hands out nothing but its table."""
    passing: list[str] = []
    try:
        token = _PASSING.set(passing)
        try:
            made = make()
        finally:
            _PASSING.reset(token)
        return written(made, name)
    finally:
        for path in passing:
            fs, place = hadoop(spark, path)
            fs.delete(place, True)


def partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def text_of(name: str = "text") -> Column:
    """The text column, null read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))
