"""Isotonic fits from counts against the library and the max-min form."""

import random

import numpy as np
import pytest

from retentia.operators import calibration as CA

SCHEMA = "churn_prob_raw double, churn_90d int"


def _max_min(rows):
    xs = sorted({x for x, _ in rows})
    n = np.cumsum([0] + [sum(1 for r in rows if r[0] == x) for x in xs])
    s = np.cumsum([0] + [sum(y for v, y in rows if v == x) for x in xs])
    k = len(xs)
    return {xs[i]: max(min((s[b + 1] - s[a]) / (n[b + 1] - n[a]) for b in range(i, k)) for a in range(i + 1))
            for i in range(k)}


@pytest.mark.parametrize("run", [100_000, 7, 1])
def test_equals_the_max_min_form_however_runs_are_cut(spark, run):
    rng = random.Random(run)
    rows = [(x, int(rng.random() < x)) for x in (round(rng.random(), 2) for _ in range(900))]
    rows += [(0.5, int(rng.random() < 0.2)) for _ in range(450)]  # a third of all rows share a score
    df = spark.createDataFrame(rows + [(None, 1), (0.3, None), (float("nan"), 1)], SCHEMA)
    blocks = CA.isotonic_blocks(df, run=run)
    value = [r.value for r in blocks.orderBy("low").collect()]
    assert value == sorted(set(value))
    assert blocks.agg({"n": "sum"}).first()[0] == len(rows)
    want = _max_min(rows)
    for held in (CA.HELD, 1):
        got = CA.isotonic_transform(df, blocks, held=held).collect()
        assert len(got) == len(rows) + 3
        for r in got:
            if r.churn_prob_raw is None or r.churn_prob_raw != r.churn_prob_raw:
                assert r.churn_prob is None
            else:
                assert r.churn_prob == pytest.approx(want[r.churn_prob_raw], abs=1e-12)


def test_lines_between_blocks_and_beyond_them(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.4, 1), (0.4, 0), (0.8, 1)], SCHEMA)
    blocks = CA.isotonic_blocks(df)
    assert [(r.low, r.high, r.n, r.value) for r in blocks.orderBy("low").collect()] == [
        (0.1, 0.2, 2, 0.0), (0.4, 0.4, 2, 0.5), (0.8, 0.8, 1, 1.0)]
    asked = [float("-inf"), 0.0, 0.15, 0.2, 0.3, 0.4, 0.6, 0.9, float("inf")]
    new = spark.createDataFrame([(x, None) for x in asked], SCHEMA)
    for held in (CA.HELD, 1):
        got = {r.churn_prob_raw: r.churn_prob for r in CA.isotonic_transform(new, blocks, held=held).collect()}
        assert [got[x] for x in asked] == pytest.approx([0, 0, 0, 0, 0.25, 0.5, 0.75, 1, 1])


def test_agrees_with_the_library(spark):
    from retentia.operators.models import Calibrator
    rng = random.Random(5)
    df = spark.createDataFrame([(x, int(rng.random() < x * x)) for x in (rng.random() for _ in range(2000))], SCHEMA)
    own = CA.isotonic_transform(df, CA.isotonic_blocks(df, run=100)).toPandas()
    lib = Calibrator("isotonic").fit(df).transform(df).toPandas()
    a, b = (d.sort_values("churn_prob_raw").churn_prob.to_numpy() for d in (own, lib))
    np.testing.assert_allclose(a, b, atol=1e-9)


def test_empty_and_one_label(spark):
    empty = spark.createDataFrame([], SCHEMA)
    blocks = CA.isotonic_blocks(empty)
    assert blocks.count() == 0 and CA.isotonic_transform(empty, blocks).count() == 0
    ones = spark.createDataFrame([(0.2, 1), (0.7, 1)], SCHEMA)
    assert [tuple(r)[:4] for r in CA.isotonic_blocks(ones).collect()] == [(0.2, 0.7, 2, 2)]
