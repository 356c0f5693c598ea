"""Isotonic calibration from counts (O-52), without a sort of rows and without a driver's or a last
task's whole column.

Rows become counts of distinct scores (combined map-side, so a score that a third of all rows
share is one row). Runs of neighbouring scores are pooled apart, each into blocks
of rising label rates; then ``FAN`` neighbouring runs are pooled together, level by level. Pooling
inside a run first is exact, as two neighbours that break the order end in one block whatever
is pooled before. N labels of 0 and 1 leave at most about N^(2/3) blocks, since so many distinct rising
fractions use up N rows; usual scores leave N^(1/3). A task pools ``FAN`` runs' blocks.

Nulls: rows without score or label take no part in the fit, and keep a null. NaN counts as null. An empty fit has
no blocks and calibrates nothing (null).
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LABEL
from ..session import cut_lineage

RUN = 100_000  # distinct scores that one task pools first
MAX_RUNS = 10_000  # runs whose borders the driver holds
FAN = 16
HELD = 500_000  # blocks that tasks hold whole (24 MB); beyond, rows meet their segment in a join
BLOCK = "run int, low double, high double, n bigint, positives bigint"


def pool(rows: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring blocks, in any order of rows, pooled until their rates rise. Counts are compared
    crosswise as whole numbers, so no rate is rounded."""
    stack: list[list] = []
    for low, high, n, k in rows.sort_values("low")[["low", "high", "n", "positives"]].itertuples(index=False, name=None):
        while stack and stack[-1][3] * n >= k * stack[-1][2]:
            before = stack.pop()
            low, n, k = before[0], n + before[2], k + before[3]
        stack.append([low, high, n, k])
    out = pd.DataFrame(stack, columns=["low", "high", "n", "positives"])
    out.insert(0, "run", np.int32(rows["run"].iloc[0]))
    return out


def isotonic_blocks(scored: DataFrame, raw: str = "churn_prob_raw", label: str = LABEL, run: int = RUN) -> DataFrame:
    """The fitted step function: (low, high, n, positives, value), one row a block, written to the checkpoint
    folder. ``label`` holds 0 and 1."""
    x = F.col(raw).cast("double") + F.lit(0.0)
    counts = cut_lineage(scored.select(x.alias("low"), F.col(label).cast("long").alias("y"))
                         .filter("low IS NOT NULL AND NOT isnan(low) AND y IS NOT NULL")
                         .groupBy("low").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives")))
    runs = max(1, min(MAX_RUNS, -(-counts.count() // run)))
    borders = []
    if runs > 1:
        borders = counts.agg(F.percentile_approx("low", [i / runs for i in range(1, runs)], 10 * runs)).first()[0]
    made = counts.select(
        F.size(F.filter(F.lit(np.array(sorted(set(borders)), float)) if borders else F.array().cast("array<double>"),
                        lambda b: b < F.col("low"))).cast("int").alias("run"),
        "low", F.col("low").alias("high"), "n", "positives")
    while True:
        made = made.groupBy("run").applyInPandas(pool, BLOCK)
        if runs == 1:
            break
        made = cut_lineage(made).withColumn("run", F.expr(f"run div {FAN}").cast("int"))
        runs = -(-runs // FAN)
    return cut_lineage(made.select("low", "high", "n", "positives", (F.col("positives") / F.col("n")).alias("value")))


def isotonic_transform(df: DataFrame, blocks: DataFrame, raw: str = "churn_prob_raw", out: str = "churn_prob",
                       held: int = HELD) -> DataFrame:
    """Adds the calibrated score: a block's value inside it, the straight line between two blocks, the
    outer values beyond them. Up to ``held`` blocks go to the tasks whole; more are cut into
    segments that rows join by a bucket of neighbouring segments, and by nothing wider."""
    n = blocks.count()
    x = F.col(raw).cast("double")
    if n == 0:
        return df.withColumn(out, F.lit(None).cast("double"))
    if n <= held:
        rows = blocks.select("low", "high", "value").toPandas().sort_values("low")  # ``held`` rows at most
        at = rows[["low", "high"]].to_numpy().ravel()
        value = np.repeat(rows["value"].to_numpy(), 2)
        points = df.sparkSession.sparkContext.broadcast((at, value))

        @F.pandas_udf("double")
        def curve(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for b in batches:
                yield pd.Series(np.where(b.isna(), np.nan, np.interp(b.to_numpy(float), *points.value)))

        made = curve(x)
        return df.withColumn(out, F.when(x.isNotNull() & ~F.isnan(x), made))
    buckets = min(MAX_RUNS, -(-n // RUN) * 16)
    borders = sorted(set(blocks.agg(F.percentile_approx("low", [i / buckets for i in range(1, buckets)],
                                                        10 * buckets)).first()[0]))
    edges = F.lit(np.array(borders, float))

    def bucket(c):
        return F.size(F.filter(edges, lambda b: b < c)).cast("int")

    # a segment reaches from one block's low end to the next one's
    from .rank import global_row_number
    numbered = global_row_number(blocks, [F.col("low")], "_i").select("_i", "low", "high", "value")
    following = numbered.select((F.col("_i") - 1).alias("_i"), F.col("low").alias("_next"), F.col("value").alias("_then"))
    segments = (numbered.join(following, "_i", "left")
                .select(F.when(F.col("_i") == 1, F.lit(float("-inf"))).otherwise(F.col("low")).alias("_low"),
                        F.col("high").alias("_high"), F.coalesce("_next", F.lit(float("inf"))).alias("_next"),
                        F.col("value").alias("_value"), F.coalesce("_then", "value").alias("_then"))
                .withColumn("_b", F.explode(F.sequence(bucket(F.col("_low")), bucket(F.col("_next"))))))
    part = (F.col("_x") - F.col("_high")) / (F.col("_next") - F.col("_high"))
    made = F.when(F.col("_x") <= F.col("_high"), F.col("_value")).when(
        F.col("_next") == float("inf"), F.col("_value")).otherwise(
        F.col("_value") + part * (F.col("_then") - F.col("_value")))
    rows = df.withColumn("_x", F.when(~F.isnan(x), x)).withColumn("_k", bucket(F.col("_x")))
    meets = (F.col("_k") == F.col("_b")) & (F.col("_x") >= F.col("_low")) & (
        (F.col("_x") < F.col("_next")) | ((F.col("_x") == float("inf")) & (F.col("_next") == float("inf"))))
    return (rows.join(segments, meets, "left").withColumn(out, made)
            .drop("_x", "_k", "_b", "_low", "_high", "_next", "_value", "_then"))
