"""Global ordering primitives: exact, skew-safe, no single-partition exchange."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retentia.operators.rank import (average_rank, exact_quantiles, global_cumsum, global_row_number,
                                     grouped_row_number)


@pytest.fixture(scope="module")
def skewed(spark):
    # a third of the rows share one value (hot key)
    n = 3000
    rng = np.random.default_rng(7)
    v = np.where(np.arange(n) % 3 == 0, 5.0, rng.integers(0, 200, n).astype(float))
    pdf = pd.DataFrame({"CustomerID": np.arange(n), "invoice_month": pd.Timestamp("2020-01-01").date(),
                        "v": v, "g": np.where(np.arange(n) % 2 == 0, "a", "b")})
    return spark.createDataFrame(pdf), pdf


def test_row_number_is_permutation_in_order(spark, skewed):
    df, pdf = skewed
    r = global_row_number(df, [F.col("v").desc(), "CustomerID"], "rk", num_partitions=7).toPandas()
    assert sorted(r.rk) == list(range(1, len(pdf) + 1))
    exp = pdf.sort_values(["v", "CustomerID"], ascending=[False, True]).CustomerID.tolist()
    assert r.sort_values("rk").CustomerID.tolist() == exp


def test_hot_value_spread_over_partitions(spark, skewed):
    df, _ = skewed
    rp = df.repartitionByRange(6, F.col("v").desc(), "CustomerID")
    sizes = rp.groupBy(F.spark_partition_id().alias("p")).count().toPandas()["count"]
    assert sizes.max() < 0.4 * sizes.sum()  # the hot third is split by the tie-break


def test_grouped_row_number_and_counts(spark, skewed):
    df, pdf = skewed
    r = grouped_row_number(df, ["g"], [F.col("v").desc(), "CustomerID"], "rk", "n").toPandas()
    for g, part in r.groupby("g"):
        assert sorted(part.rk) == list(range(1, len(part) + 1))
        assert (part.n == len(part)).all()


def test_average_rank_matches_pandas(spark, skewed):
    df, pdf = skewed
    got = average_rank(df, "v", "ar", True, ("CustomerID", "invoice_month")).toPandas().sort_values("CustomerID")
    exp = pdf.sort_values("CustomerID").v.rank(method="average")
    np.testing.assert_allclose(got.ar.values, exp.values)
    got_d = average_rank(df, "v", "ar", False, ("CustomerID", "invoice_month")).toPandas().sort_values("CustomerID")
    np.testing.assert_allclose(got_d.ar.values, pdf.sort_values("CustomerID").v.rank(method="average", ascending=False).values)


def test_ranks_of_hot_values_fill_no_task(spark, monkeypatch):
    from retentia.operators import rank as R
    n = 4000
    rng = np.random.default_rng(3)
    v = np.where(np.arange(n) % 2 == 0, 5.0, rng.integers(0, 900, n).astype(float))
    few = np.where(np.arange(n) % 4 == 0, 2.0, 1.0)
    pdf = pd.DataFrame({"CustomerID": np.arange(n), "v": pd.Series(v).mask(np.arange(n) % 11 == 0), "few": few})
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.shuffle.partitions")}
    try:
        for k, x in zip(kept, ("false", "-1", "16"), strict=True):
            spark.conf.set(k, x)
        monkeypatch.setattr(R, "BROADCAST_VALUES", 100)
        monkeypatch.setattr(R, "HOT_SHARE", 50)
        out, bounds = R.average_ranks(df, [("v", "rv", True), ("few", "rf", False)])
        sizes = out.groupBy(F.spark_partition_id().alias("p")).count().toPandas()["count"]
        got = out.toPandas().sort_values("CustomerID")
    finally:
        for k, x in kept.items():
            spark.conf.set(k, x)
    assert sizes.max() < 0.2 * n  # a value of half of the rows, and the nulls, are spread
    np.testing.assert_allclose(got.rv.values, pdf.v.rank(method="average").values)
    np.testing.assert_allclose(got.rf.values, pdf.few.rank(method="average", ascending=False).values)
    assert bounds["rf"] == (got.rf.min(), got.rf.max())


def test_exact_quantiles_match_numpy(spark, skewed):
    df, pdf = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    q = exact_quantiles(df, ["g"], "v", probs).toPandas()
    for g, part in pdf.groupby("g"):
        exp = np.quantile(part.v.values, probs)
        got = q[q.g == g].sort_values("q").value.values
        np.testing.assert_allclose(got, exp)


def test_global_cumsum(spark, skewed):
    df, pdf = skewed
    c = global_cumsum(df, ["CustomerID"], ["v"], num_partitions=5).toPandas().sort_values("CustomerID")
    np.testing.assert_allclose(c.cum_v.values, pdf.sort_values("CustomerID").v.cumsum().values)


def test_rank_plans_have_no_single_partition(spark, skewed):
    from retentia.operators.evaluate import policy_metrics
    df, _ = skewed
    r = global_row_number(df, [F.col("v").desc(), "CustomerID"], "rk")
    assert "SinglePartition" not in r._jdf.queryExecution().executedPlan().toString()
    m = policy_metrics(df.withColumn("churn_90d", (F.col("CustomerID") % 2).cast("int"))
                         .withColumn("value_pos", F.col("v")).withColumn("policy_ml", F.col("v")),
                       [0.1, 0.2], ["policy_ml"], ["g"], include_random=False)
    assert "SinglePartition" not in m._jdf.queryExecution().executedPlan().toString()
