"""Selection by counting: the same rows as a full sort, with ties, nulls, hot groups and large ids."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentia.operators import selection as S

SCHEMA = "g string, CustomerID bigint, invoice_month date, v double"


def _rows(n, seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        kind = i % 6
        v = (None if kind == 0 and i % 5 == 0 else float("nan") if i == 7 else 5.0 if kind < 2
             else float(rng.normal()) if kind < 4 else float(10.0 ** rng.integers(-300, 300)) if kind == 4
             else round(float(rng.normal()), 1))
        g = None if i % 97 == 0 else "hot" if i % 3 else f"g{i % 5}"
        out.append((g, int(rng.integers(0, n // 3)) + (1 << 61), dt.date(2000 + i // 1200, 1 + i % 12, 1 + (i // 12) % 28), v))
    return list({(r[1], r[2]): r for r in out}.values())


def _key(r):
    v = r[3]
    return (np.inf if v is None or np.isnan(v) else -v, r[1], r[2])


def _n(total, k):
    return max(1, round(total * k))


@pytest.fixture(scope="module")
def frame(spark):
    rows = _rows(4000, 3)
    return spark.createDataFrame(rows, SCHEMA).repartition(5), rows


@pytest.mark.parametrize("k", [0.0001, 0.31, 0.9])
def test_slice_equals_full_sort(frame, k):
    df, rows = frame
    want = {(r[1], r[2]) for r in sorted(rows, key=_key)[:_n(len(rows), k)]}
    got = [(r.CustomerID, r.invoice_month) for r in S.top_k_slice(df, "v", k).collect()]
    assert len(got) == len(want) and set(got) == want


def test_small_sketches_need_more_passes_only(frame, monkeypatch):
    df, rows = frame
    monkeypatch.setattr(S, "POINTS", 4)
    monkeypatch.setattr(S, "ACCURACY", 5)  # estimates far off: the counts still decide
    ordered = sorted(rows, key=_key)
    flagged = S.target_flags(df, "v", [0.05, 0.31]).collect()
    for k, col in ((0.05, "target_k05"), (0.31, "target_k31")):
        want = {(r[1], r[2]) for r in ordered[:_n(len(rows), k)]}
        assert {(r.CustomerID, r.invoice_month) for r in flagged if r[col] == 1} == want


@pytest.mark.parametrize("limit", [S.MAX_GROUPS, 2])
def test_groups_equal_full_sort(frame, monkeypatch, limit):
    df, rows = frame
    monkeypatch.setattr(S, "MAX_GROUPS", limit)
    got = {}
    for r in S.top_rows(df, "v", [0.05, 0.2], ["g"]).collect():
        got.setdefault((r.g, r.budget_k, r._n, r._n_rows), set()).add((r.CustomerID, r.invoice_month))
    want = {}
    for g in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == g], key=_key)
        for k in (0.05, 0.2):
            n = _n(len(own), k)
            want[(g, k, n, len(own))] = {(r[1], r[2]) for r in own[:n]}
    assert got == want


def test_ties_on_score_and_id(spark):
    rows = [("a", 1, dt.date(2001, 1 + i // 28, 1 + i % 28), 2.0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(r.invoice_month for r in S.top_k_slice(df, "v", 0.1).collect())
    assert got == sorted(r[2] for r in rows)[:30]


def test_empty_one_row_all_null_and_repeated(spark):
    df = spark.createDataFrame([("a", 1, dt.date(2001, 1, 1), None)], SCHEMA)
    assert S.top_k_slice(df.limit(0), "v", 0.1).count() == 0
    assert S.top_rows(df.limit(0), "v", [0.1], ["g"]).count() == 0
    assert [r.target_k10 for r in S.target_flags(df, "v", [0.1]).collect()] == [1]
    assert S.target_flags(df.limit(0), "v", [0.1]).columns[-1] == "target_k10"
    nulls = spark.createDataFrame([("a", i, None, None) for i in range(10)], SCHEMA)
    assert [r.CustomerID for r in S.top_k_slice(nulls, "v", 0.3).orderBy("CustomerID").collect()] == [0, 1, 2]
    same = spark.createDataFrame([("a", 1, dt.date(2001, 1, 1), 1.0)] * 10, SCHEMA)
    assert S.top_k_slice(same, "v", 0.3).count() == 10  # one key: all or none
    with pytest.raises(TypeError):
        S.top_k_slice(df, "v", 0.1, ["g"])


def test_lists_hold_each_budgets_rows(frame):
    df, rows = frame
    lists = S.target_lists(S.target_flags(df, "v", [0.05, 0.2]), [0.05, 0.2])
    sizes = {r.budget_k: r["count"] for r in lists.groupBy("budget_k").count().collect()}
    assert sizes == {0.05: _n(len(rows), 0.05), 0.2: _n(len(rows), 0.2)}


def test_plan_has_no_sort_and_no_shuffle(frame):
    df, _ = frame
    narrow = df.sparkSession.createDataFrame(df.collect(), SCHEMA)
    plan = S.target_flags(narrow, "v", [0.05, 0.2])._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    plan = S.top_rows(narrow, "v", [0.05], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hash" not in plan and "Exchange range" not in plan


def test_median_of_a_value_that_millions_of_rows_share(spark):
    rows = spark.range(4_500_000).select(F.lit(2.0).alias("x"))
    assert S.medians(rows, ["x"]) == {"x": 2.0}
