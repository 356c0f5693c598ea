"""Boosted trees: plain numpy fits, hand-made trees, attribution, calibration, edge cases."""

import heapq

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F
from retentia.operators import boosting as B

COLS = ["f0", "f1", "f2"]


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(900, 3))
    x[r.random((900, 3)) < 0.03] = np.nan
    z = np.nan_to_num(x)
    y = (z[:, 0] + z[:, 1] ** 2 + r.normal(size=900) > 0.7).astype(int)
    m = r.integers(0, 10, 900)
    df = spark.createDataFrame(pd.DataFrame({**{f"f{i}": x[:, i] for i in range(3)}, "churn_90d": y, "m": m}))
    return df, x, y, m


def plain_tree(bins, g, h, growth):
    """Best splits by trying every threshold of every feature, depth-wise or best leaf first."""
    def best(rows):
        made = (1e-9, None)
        G, H = g[rows].sum(), h[rows].sum()
        for f in range(bins.shape[1]):
            for b in range(0, B.BINS):
                low = bins[rows, f] <= b
                if min(low.sum(), (~low).sum()) < max(1, growth.min_rows):
                    continue
                gl, hl = g[rows][low].sum(), h[rows][low].sum()
                if min(hl, H - hl) < growth.min_child_weight:
                    continue
                lam = growth.reg_lambda
                gain = gl ** 2 / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G ** 2 / (H + lam)
                if gain > made[0] + 1e-9:
                    made = (gain, (f, b))
        return made

    value = np.zeros(len(bins))
    leaves, count, queue, n = [], 0, [], 1

    def offer(rows, depth):
        nonlocal count
        gain, cut = best(rows) if growth.max_depth is None or depth < growth.max_depth else (0, None)
        if cut is None:
            leaves.append(rows)
        else:
            heapq.heappush(queue, (-gain, count, rows, depth, cut))
            count += 1

    offer(np.arange(len(bins)), 0)
    while queue:
        _, _, rows, depth, (f, b) = heapq.heappop(queue)
        if growth.max_leaves is not None and n >= growth.max_leaves:
            leaves.append(rows)
            continue
        n += 1
        low = bins[rows, f] <= b
        offer(rows[low], depth + 1)
        offer(rows[~low], depth + 1)
    for rows in leaves:
        value[rows] = -growth.learning_rate * g[rows].sum() / (h[rows].sum() + growth.reg_lambda)
    return value, len(leaves)


@pytest.mark.parametrize("family", ["xgboost", "lightgbm"])
def test_a_window_equals_a_plain_fit(table, family):
    df, x, y, m = table
    growth = B.growth(family, {"n_estimators": 4, "subsample": 1.0, "colsample_bytree": 1.0, "num_leaves": 9,
                               **({"max_depth": 3} if family == "xgboost" else {})})
    models = B.grow(df, [B.Booster(family, last, growth) for last in (4, 9)], COLS, F.col("m"))
    for model in models:
        own = m <= model.last
        bins, label = model.bins(x[own]), y[own]
        margin = np.full(len(label), np.log(label.mean() / (1 - label.mean())))
        for tree in model.trees:
            p = 1 / (1 + np.exp(-margin))
            value, leaves = plain_tree(bins, p - label, p * (1 - p), growth)
            assert (tree.feature < 0).sum() == leaves <= (9 if family == "lightgbm" else 8)
            np.testing.assert_allclose(tree.margin(bins), value, atol=1e-9)
            margin += value


def test_both_ways_grow_the_same_trees(table, monkeypatch):
    df, x, _, _ = table
    monkeypatch.setattr(B, "BLOCK_ROWS", 300)
    models = [B.Booster(f, last, B.growth(f, {"n_estimators": 5})) for last in (4, 9) for f in ("xgboost", "lightgbm")]
    near = B.grow(df, models, COLS, F.col("m"))
    far = B.grow(df, models, COLS, F.col("m"), shared_bytes=0)
    for a, b in zip(near, far, strict=True):
        assert a.base == pytest.approx(b.base) and (a.medians == b.medians).all()
        np.testing.assert_allclose(a.margin(a.bins(x)), b.margin(b.bins(x)), atol=1e-5)
        assert all((s.feature == t.feature).all() and (s.threshold == t.threshold).all()
                   for s, t in zip(a.trees, b.trees, strict=True))


@pytest.mark.parametrize("here", [True, False])
def test_growing_together_derives_larger_children_over_several_checkpoints(table, monkeypatch, here):
    df, x, _, _ = table
    model = B.Booster("lightgbm", 4, B.growth("lightgbm", {"n_estimators": 5}))
    near = B.grow(df, [model], COLS, F.col("m"))[0]
    for name, value in (("BLOCK_ROWS", 100), ("DERIVED_ROWS", 0), ("TREES_A_CHECKPOINT", 2),
                        ("SUMS_BYTES", 1 << 30 if here else 0)):
        monkeypatch.setattr(B, name, value)
    summed, gradients = [], B._gradients

    def counted(models, growing, asked, t, width):
        summed.append((len(asked[0]), len(growing[0].unknown())))
        return gradients(models, growing, asked, t, width)

    monkeypatch.setattr(B, "_gradients", counted)
    far = B.grow(df, [model], COLS, F.col("m"), shared_bytes=0)[0]
    np.testing.assert_allclose(near.margin(near.bins(x)), far.margin(far.bins(x)), atol=1e-9)
    read, asked = np.array(summed).sum(axis=0)
    assert read <= 0.6 * asked if here else read == asked  # one of two children needs no rows


def test_windows_without_rows_or_of_one_label(spark, table):
    df = table[0]
    models = B.grow(df, [B.Booster("xgboost", -5, B.growth("xgboost", {"n_estimators": 2})),
                         B.Booster("lightgbm", 9, B.growth("lightgbm", {"n_estimators": 2}))], COLS, F.col("m"))
    assert [len(t.feature) for t in models[0].trees] == [1, 1]
    one = B.grow(df.withColumn("churn_90d", F.lit(1)), [B.Booster("xgboost", 9, B.growth("xgboost", {"n_estimators": 2}))],
                 COLS, F.col("m"))[0]
    scored = B.score(df, one, COLS, "p").select("p").toPandas().p
    assert (scored > 0.99).all()
    assert B.score(df.limit(0), one, COLS, "p").count() == 0


def test_contributions_add_up_and_importance_is_their_mean(table):
    df, x, _, _ = table
    model = B.grow(df, [B.Booster("lightgbm", 9, B.growth("lightgbm", {"n_estimators": 6}))], COLS, F.col("m"))[0]
    rows = B.explain(df, model, COLS).collect()
    for r in rows:
        assert r.base_value + sum(c.contribution for c in r.contributions) == pytest.approx(r.margin)
    margin = {round(v, 9) for v in model.margin(model.bins(x))}
    assert {round(r.margin, 9) for r in rows} == margin
    got = {r.feature: r.importance for r in B.importance(df, model, COLS).collect()}
    for i, c in enumerate(COLS):
        assert got[c] == pytest.approx(np.mean([abs(r.contributions[i].contribution) for r in rows]))


def test_hand_made_tree():
    tree = B.Tree(np.array([0, 1, -1, -1, -1]), np.array([2, 1, 0, 0, 0]), np.array([1, 3, 0, 0, 0]),
                  np.array([2, 4, 0, 0, 0]), np.array([0.0, -1.0, 1.0, -2.0, 0.5]), np.ones(5))
    model = B.Booster("x", 0, B.Growth(), [np.array([1.0, 2.0]), np.array([5.0])], np.array([1, 1]), 0.25, [tree])
    raw = np.array([[0.5, 4.0], [2.0, 9.0], [3.0, 0.0], [np.nan, 6.0]])
    bins = model.bins(raw)
    assert bins.tolist() == [[1, 1], [2, 2], [3, 1], [1, 2]]
    assert model.margin(bins).tolist() == [-1.75, 0.75, 1.25, 0.75]
    base, made = model.contributions(bins)
    assert base == 0.25 and made.tolist() == [[-1.0, -1.0], [-1.0, 1.5], [1.0, 0.0], [-1.0, 1.5]]


def test_platt_by_group_equals_newton(spark):
    r = np.random.default_rng(5)
    raw, group = r.random(600), np.arange(600) % 2
    y = (r.random(600) < raw * (0.5 + 0.5 * group)).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"k": group, "churn_prob_raw": raw, "churn_90d": y}))
    got = {row.g: (row.a, row.b) for row in B.platt(df, "k").collect()}
    for k in (0, 1):
        z, own = np.column_stack([np.ones(300), raw[group == k]]), y[group == k]
        w = np.zeros(2)
        for _ in range(40):
            p = 1 / (1 + np.exp(-z @ w))
            w -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag([0.0, 1.0]),
                                 z.T @ (p - own) + np.diag([0.0, 1.0]) @ w)
        assert got[k] == pytest.approx((w[1], w[0]), abs=1e-7)


def test_gains_of_a_hand_made_tree():
    tree = B.Tree(np.array([1, -1, -1]), np.array([1, 0, 0]), np.array([1, 0, 0]), np.array([2, 0, 0]),
                  np.array([0.0, -0.5, 0.5]), np.array([4.0, 2.0, 2.0]))
    assert B.Booster("x", 0, B.Growth(), [np.array([1.0])] * 2, None, 0.0, [tree]).gains().tolist() == [0.0, 1.0]
    assert B.Booster("x", 0, B.Growth(), [np.array([1.0])] * 2).gains().tolist() == [0.0, 0.0]


def test_a_fitted_boosted_family_is_saved_and_explained(spark, table, tmp_path):
    from retentia.operators.explain import explain_occlusion
    from retentia.operators.models import feature_importance, train_and_score
    from retentia.sources import sinks
    df = table[0].select(F.monotonically_increasing_id().alias("CustomerID"), "churn_90d", *COLS,
                         F.add_months(F.lit("2020-01-01").cast("date"), F.col("m").cast("int")).alias("invoice_month"))
    df = df.localCheckpoint()
    scored, tm = train_and_score("xgboost", df, df, COLS, {"n_estimators": 4})
    assert {r.feature for r in feature_importance(tm).collect()} == set(COLS)
    again = sinks.load_model(sinks.save_model(tm, str(tmp_path), "r1")).score(df)
    want = {r.CustomerID: (r.churn_prob_raw, r.churn_prob) for r in scored.collect()}
    assert want == {r.CustomerID: (r.churn_prob_raw, r.churn_prob) for r in again.collect()}
    rows = df.limit(30)
    for i, c in enumerate(COLS):  # the drop of probability with one feature at its median
        put = tm.score(rows.withColumn(c, F.lit(tm.model.surrogates[i]))).collect()
        put = {r.CustomerID: r.churn_prob_raw for r in put}
        for r in explain_occlusion(rows, tm, ["CustomerID"]).collect():
            assert r.contributions[i].contribution == pytest.approx(want[r.CustomerID][0] - put[r.CustomerID])


def walked(tree, bins):
    """Margins by walking each row down."""
    made = []
    for row in bins:
        node = 0
        while tree.feature[node] >= 0:
            node = (tree.left if row[tree.feature[node]] <= tree.threshold[node] else tree.right)[node]
        made.append(tree.value[node])
    return np.array(made)


@pytest.mark.parametrize("leaves", [1, 31, 64, 90])
def test_sets_of_leaves_give_what_a_walk_gives(leaves):
    r = np.random.default_rng(leaves)
    feature, threshold, left, right = [-1], [0], [0], [0]
    while feature.count(-1) < leaves:  # split a leaf at random
        node = r.choice([i for i, f in enumerate(feature) if f < 0])
        feature[node], threshold[node], left[node], right[node] = r.integers(4), r.integers(1, 30), len(feature), len(feature) + 1
        feature, threshold, left, right = ([*x, y, y] for x, y in ((feature, -1), (threshold, 0), (left, 0), (right, 0)))
    tree = B.Tree(*(np.array(x) for x in (feature, threshold, left, right)), r.normal(size=len(feature)), np.ones(len(feature)))
    assert (tree.words() is None) == (leaves > B.PLACES)
    bins = r.integers(1, 32, (2000, 4)).astype(np.uint8)
    assert (tree.margin(bins) == walked(tree, bins)).all()
    model = B.Booster("x", 0, B.Growth(), [np.arange(30.0)] * 4, np.ones(4, int), 0.5, [tree, tree])
    assert model.margin(bins) == pytest.approx(0.5 + 2 * walked(tree, bins))
    put = np.array([3, 20, 9, 30])
    for f, got in enumerate(model.occluded(bins, put)[1:]):
        variant = bins.copy()
        variant[:, f] = put[f]
        assert got == pytest.approx(0.5 + 2 * walked(tree, variant))
    base, parts = model.contributions(bins)
    assert base + parts.sum(axis=1) == pytest.approx(model.margin(bins))


def test_joint_sums_and_derived_children_grow_the_trees_of_plain_sums(monkeypatch):
    r = np.random.default_rng(3)
    n = 3000
    data = r.normal(size=(n, 5))
    rows = B._Rows.__new__(B._Rows)
    edges = [np.quantile(data[:, f], np.linspace(0.02, 0.98, k)) for f, k in enumerate((62, 62, 40, 3, 20))]
    rows.key, rows.month = r.integers(-2**62, 2**62, n), np.zeros(n, "<i4")
    rows.label = (data[:, 0] + data[:, 1] * data[:, 2] + r.normal(size=n) > 0).astype(float)
    rows.bins = np.asfortranarray(B.quantised(data, edges))
    for family in ("xgboost", "lightgbm"):
        model = B.Booster(family, 0, B.growth(family, {"n_estimators": 5}), edges)
        plain = B.grown(model, rows)
        calls = []
        with monkeypatch.context() as m:
            m.setattr(B, "MIN_ROWS", 1)
            m.setattr(B, "JOINT_ROWS", 100)
            summed = B._joint_sums
            m.setattr(B, "_joint_sums", lambda codes, *a: calls.append(len(codes)) or summed(codes, *a))
            joint = B.grown(B.replace(model, trees=[]), rows)
        assert calls and max(calls) < 5  # fewer sums than features
        for a, b in zip(plain.trees, joint.trees, strict=True):
            np.testing.assert_allclose(a.margin(rows.bins), b.margin(rows.bins), atol=1e-6)
        plain.trees.clear()


def test_many_windows_score_larger_batches(spark, table, monkeypatch):
    df, x, _, m = table
    models = B.grow(df, [B.Booster("lightgbm", last, B.growth("lightgbm", {"n_estimators": 3})) for last in (4, 6)],
                    COLS, F.col("m"))
    rows = df.coalesce(1).withColumn("id", F.monotonically_increasing_id())
    sizes = []
    monkeypatch.setattr(B, "WINDOW_ROWS", 300)
    for batch in B._gathered(iter(__import__("pyarrow").Table.from_pandas(rows.toPandas()).to_batches(max_chunksize=70)), 300):
        sizes.append(batch.num_rows)
    assert sum(sizes) == 900 and all(s >= 300 for s in sizes[:-1]) and max(sizes) < 400
    got = B.score_windows(rows, models, [[(5, 6, "calibrate"), (7, 8, "test")], [(7, 7, "calibrate")]], COLS, "m", ["id"])
    got = got.toPandas()
    assert len(got) == np.isin(m, [5, 6, 7, 8]).sum() + (m == 7).sum()
    whole = {k: dict(zip(rows.toPandas().id, 1 / (1 + np.exp(-mod.margin(mod.bins(rows.select(*COLS).toPandas().to_numpy())))),
                         strict=True)) for k, mod in enumerate(models)}
    assert all(p == pytest.approx(whole[k][i]) for k, i, p in zip(got.k, got.id, got.churn_prob_raw))


def test_a_block_of_joint_bins_sums_and_places_its_rows(monkeypatch):
    r = np.random.default_rng(7)
    n, sizes = 1500, (64, 64, 30, 5)
    bins = np.column_stack([r.integers(0, s, n) for s in sizes]).astype(np.uint8)  # 0: null
    data = (r.integers(-2**62, 2**62, n).astype("<i8").tobytes() + np.zeros(n, "<i4").tobytes()
            + r.integers(0, 2, n).astype("u1").tobytes() + np.ascontiguousarray(bins.T).tobytes())
    model = B.Booster("xgboost", 0, B.growth("xgboost"), [np.arange(s - 2.0) for s in sizes], np.array([9, 20, 3, 2]))
    cut = B._Cut(*B._cut_rows([model])((0, n, data, bytes(8 * n))), [model])
    full = [np.where(bins[:, f] == 0, model.medians[f], bins[:, f]) for f in range(4)]
    assert all((a == b).all() for a, b in zip(cut.columns(model, slice(0, n)), full))
    assert (cut.counts(n) == B._Rows(n, data).counts(n)).all()
    own, g, h = np.sort(r.choice(n, 700, False)), r.normal(size=700), r.random(700)
    monkeypatch.setattr(B, "JOINT_ROWS", 1)
    assert len(cut.groups) < 4
    np.testing.assert_allclose(cut.sums(model, own, {0, 1, 2, 3}, g, h),
                               B._node_sums(full, {0, 1, 2, 3}, own, g, h), atol=1e-9)
    for leaves in (1, 40, 80):
        feature, threshold, left, right = [-1], [0], [0], [0]
        for node in range(leaves - 1):
            feature[node], threshold[node], left[node], right[node] = node % 4, r.integers(1, sizes[node % 4]), 2 * node + 1, 2 * node + 2
            feature, threshold, left, right = ([*x, y, y] for x, y in ((feature, -1), (threshold, 0), (left, 0), (right, 0)))
        tree = B.Tree(*(np.array(x) for x in (feature, threshold, left, right)), r.normal(size=len(feature)), np.ones(len(feature)))
        state = (0, n, [n], data[:8 * n] + cut.codes.tobytes() + cut.label.tobytes(), bytes(8 * n))
        moved = np.frombuffer(next(B._advance([model], {0: tree})(iter([state])))[4])
        assert (moved == walked(tree, np.column_stack(full))).all()


def test_a_task_reads_several_blocks(spark, table, monkeypatch):
    df, x, y, m = table
    monkeypatch.setattr(B, "BLOCK_ROWS", 50)
    monkeypatch.setattr(B, "MIN_ROWS", 1)
    rows = df.select(F.col("m").cast("int").alias("month"), F.col("churn_90d").cast("int").alias("label"),
                     F.xxhash64("m").alias("key"), F.array(*COLS).alias("x"))
    made = B._blocks(rows, [np.array([0.0])] * 3, [9], 900)
    assert made.rdd.getNumPartitions() == 8 < made.count() and made.agg(F.sum("n")).first()[0] == 900
