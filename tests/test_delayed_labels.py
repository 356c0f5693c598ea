"""Late labels: window ends, restarts and open predictions; medians by counting."""

import datetime as dt
import math
import random
import tempfile

import numpy as np
import pytest

UTC = dt.timezone.utc
T0 = dt.datetime(2024, 1, 10, 12, tzinfo=UTC)
DAY = dt.timedelta(days=1)
US = dt.timedelta(microseconds=1)
ASKED, CAME = "CustomerID bigint, T timestamp, churn_prob double", "CustomerID bigint, InvoiceDate timestamp"


class Streams:
    """Two folders that grow, and the labels drained from them."""

    def __init__(self, spark, horizon):
        from retentia.streaming import labels as SL
        self.spark, self.horizon, self.at = spark, horizon, tempfile.mkdtemp(prefix="retentia-labels-")
        self.SL = SL

    def add(self, asked, came):
        for name, rows, schema in (("p", asked, ASKED), ("q", came, CAME)):
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.at}/{name}")
        made = [self.spark.readStream.schema(s).parquet(f"{self.at}/{n}") for n, s in (("p", ASKED), ("q", CAME))]
        self.SL.drain(self.spark, self.SL.answers(*made, self.horizon), f"{self.at}/out", f"{self.at}/ckpt")
        return {(r.CustomerID, r.T): r for r in self.SL.labels(self.spark, f"{self.at}/out", self.horizon).collect()}


def _naive(t):  # collected instants are shown in the machine's zone
    return t.astimezone().replace(tzinfo=None)


def test_window_ends_and_a_restart(spark):
    s = Streams(spark, 90)
    asked = [(i, T0, 0.5) for i in range(1, 6)] + [(None, T0, 0.5), (9, None, 0.5), (5, T0, 0.5)]
    came = [(1, T0), (2, T0 + US), (3, T0 + 90 * DAY), (4, T0 + 90 * DAY + US), (None, T0 + DAY)]
    first = s.add(asked, [c for c in came if c[1] < T0 + DAY])
    assert {k[0]: r.churned for k, r in first.items()} == {2: 0}  # nobody else's horizon has passed
    assert not any(r.closed for r in first.values())
    last = T0 + 120 * DAY
    got = s.add([(7, last, 0.5)], [*came[2:4], (8, last)])
    assert {k[0]: (r.churned, r.closed) for k, r in got.items()} == {
        1: (1, True), 2: (0, True), 3: (0, True), 4: (1, True), 5: (1, True)}
    assert got[(3, _naive(T0))].first_return == _naive(T0 + 90 * DAY)


def test_random_history_equals_a_plain_loop(spark):
    rng, s = random.Random(3), Streams(spark, 7)
    came = [(0 if rng.random() < 0.4 else rng.randrange(20), T0 + dt.timedelta(seconds=rng.randrange(60 * 86400)))
            for _ in range(600)]
    last = {}
    for c, t in came:  # one prediction a customer and day, a third of them for one customer
        last[c, t.date()] = max(t, last.get((c, t.date()), t))
    asked = [(c, t, 0.25) for (c, _), t in last.items()]
    got = s.add(asked, came)
    mark = min(max(t for _, t, _ in asked), max(t for _, t in came)) - 2 * DAY
    closed = {k: r.churned for k, r in got.items() if r.closed}
    assert closed == {(c, _naive(t)): int(not any(d == c and t < u <= t + 7 * DAY for d, u in came))
                      for c, t, _ in asked if t + 8 * DAY < mark}
    rep = s.SL.label_report(spark, f"{s.at}/out", 7, "day").collect()
    assert 0 < sum(r.n_predictions for r in rep) <= len(closed)
    for r in rep:
        own = [int(not any(d == c and t < u <= t + 7 * DAY for d, u in came)) for c, t, _ in asked if t.date() == r.period]
        assert (r.n_predictions, r.n_churned) == (len(own), sum(own))
        assert math.isclose(r.calibration_gap, 0.25 - sum(own) / len(own), abs_tol=1e-12)


def test_no_rows_at_all(spark):
    s = Streams(spark, 7)
    assert s.add([], []) == {}
    assert s.SL.label_report(spark, f"{s.at}/out", 7).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 5000])
def test_medians_equal_numpy(spark, n):
    from retentia.operators import selection as S
    rng = random.Random(n)
    rows = [(rng.gauss(0, 1e6), float(rng.randrange(3)), None if rng.random() < 0.3 else rng.random(),
             float("nan") if i % 4 == 0 else -float(i), None, rng.choice([1, 1 << 52]), 0.0 if i % 2 else -0.0)
            for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f bigint, g double")
    got = S.medians(df, df.columns)
    for i, c in enumerate(df.columns):
        own = [float(r[i]) for r in rows if r[i] is not None and r[i] == r[i]]
        assert got[c] == (None if not own else np.median(own)), c


def test_imputer_holds_the_medians(spark):
    from retentia.operators.models import median_imputer
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (None, 8.0), (4.0, float("nan"))], "a double, b double")
    fitted = median_imputer(df, ["a", "b"])
    assert fitted.surrogateDF.first().asDict() == {"a": 2.0, "b": 6.5}
    assert [r.b__imp for r in fitted.transform(df).collect()] == [6.5, 5.0, 8.0, 6.5]
    with pytest.raises(ValueError):
        median_imputer(df.filter("a IS NULL"), ["a"])
