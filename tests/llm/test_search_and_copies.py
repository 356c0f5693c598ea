"""Near-duplicates, joins and exact top-k against brute force."""

import math
from fractions import Fraction

import collections

import numpy as np
import pytest
from fixtures import docs  # noqa: F401

from retentia.llm import bitslices, graph, lsh_forest, pivots
from pyspark.sql import functions as F


def components(n, pairs):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(201, 200), (200, 201), (300, 300)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(40))
    assert got[200] == got[201] == 200 and 300 not in got
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_pivot_links_equal_brute_force(spark, block_rows):
    r = np.random.default_rng(5)
    centres = r.normal(size=(30, 24))
    rows = [c + r.normal(size=24) * s for c in centres for s in (0, 0.05, 0.2, 0.4, 0.5)]
    rows += [centres[0] + r.normal(size=24) * 0.1 for _ in range(60)]  # a large group of near copies
    rows += [rows[0], rows[0] * 3, np.zeros(24)]
    u = np.array(rows)
    norm = np.linalg.norm(u, axis=1)
    u = u / np.where(norm == 0, 1, norm)[:, None]
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    want = components(len(rows), zip(*np.nonzero(linked), strict=True))
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    data += [(1000, None), (1001, []), (1002, [float("nan")] * 24), (1003, [None] * 24), (None, data[0][1])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("kept", F.lit(1))
    got = {x.vec_id: x for x in pivots.near_duplicates(df, block_rows=block_rows).collect()}
    found = sum(got[i].n_links for i in range(len(rows)))
    assert found >= 0.99 * linked.sum() and all(got[i].n_links <= linked[i].sum() for i in range(len(rows)))
    assert sum(got[i].component_id == want[i] for i in range(len(rows))) >= 0.99 * len(rows)
    assert all(got[i].kept == (got[i].component_id == i) for i in range(len(rows)))
    for i in (1000, 1001, 1002, 1003, len(rows) - 1):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id) == (0, None)
    assert pivots.near_duplicates(df.limit(0)).count() == 0


def jaccard(rows):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    pairs = [(a, b) for a in range(len(rows)) for b in range(a)
             if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    links = collections.Counter(x for p in pairs for x in p)
    return [links[i] for i in range(len(rows))], components(len(rows), pairs)


@pytest.mark.parametrize("block_rows", [1000, 8])
def test_jaccard_join_equals_brute_force(spark, docs, block_rows):
    r = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for length in (12, 40, 120, 400):
        for _ in range(4):
            base = list(r.choice(words, length))
            texts.append(" ".join(base))
            for changes in (1, 1, 2, 4, 9):
                own = list(base)
                for at in r.integers(0, length, changes):
                    own[at] = str(r.choice(words))
                texts.append(" ".join(own))
    base = list(r.choice(words, 100))  # a large group of near copies
    for _ in range(40):
        own = list(base)
        own[int(r.integers(0, 100))] = "x"
        texts.append(" ".join(own))
    texts += [texts[0], texts[0].upper(), "", "", None, "one two", "one two", "One  two", "a b c d e", "x" * 100_000]
    rows = list(enumerate(texts))
    links, classes = jaccard(rows)
    got = {x.doc_id: x for x in lsh_forest.jaccard_join(
        docs([*rows, (None, texts[0])], extra="cls"), block_rows=block_rows).collect()}
    right = sum(got[i].n_links == links[i] for i, _ in rows)
    assert right >= len(rows) - 2 and all(got[i].n_links <= links[i] for i, _ in rows)
    assert sum(got[i].class_id == classes[i] for i, _ in rows) >= len(rows) - 2
    assert all(got[i].n_links == 0 and got[i].kept for i, t in rows if not t)
    assert got[None].class_id is None
    assert lsh_forest.jaccard_join(docs([(1, "a")]).limit(0)).count() == 0


def test_matched_prefix_reaches_the_target_recall():
    depth = lsh_forest.matched_depth(0.8, 0.999)
    assert lsh_forest.recall(0.8, depth) >= 0.999 > lsh_forest.recall(0.8, depth + 1)


def test_trees_reach_depth_seven():
    assert lsh_forest.TREES == 32 and lsh_forest.matched_depth(0.8, 0.999) == 7
    assert lsh_forest.recall(0.8, 7) > 0.9994


def test_isolated_pairs_that_miss_the_first_prefix_meet_at_a_shorter_one(spark, docs):
    r = np.random.default_rng(8)
    rows = []
    for i in range(400):  # one word of 49 changed: 40 of 50 shingles, exactly the threshold
        base = [f"p{i}w{k}" for k in r.permutation(49)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:20], "x", *base[21:]]))]
    got = lsh_forest.jaccard_join(docs(rows), target_recall=0.5).collect()
    assert all(x.n_links == 1 and x.class_id == x.doc_id // 2 * 2 for x in got)


def test_agreeing_signatures_equal_the_plain_comparison():
    r = np.random.default_rng(4)
    sig = r.integers(0, 60000, (300, 256)).astype(np.uint16)
    for i in range(1, 200):
        at = r.random(256) < r.uniform(0.5, 1)
        sig[i, at] = sig[i // 3, at]
    rows = np.arange(0, 300, 2)
    want = np.zeros((300, 300), bool)
    for i in rows:
        want[i] = (sig == sig[i]).mean(axis=1) >= 0.7
    assert (lsh_forest.agreeing(sig, rows, 0.7) == want).all() and want.sum() > 200


def test_jaccard_join_takes_candidates_by_its_own_shingles(spark, docs):
    r = np.random.default_rng(13)
    rows = []
    for i in range(40):  # two words of 56 changed: 48 of 60 shingles of three words
        base = [f"p{i}w{k}" for k in r.permutation(56)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:15], "x", *base[16:40], "y", *base[41:]]))]
    got = lsh_forest.jaccard_join(docs(rows), n_words=3).collect()
    assert all(x.n_links == 1 and x.class_id == x.doc_id // 2 * 2 for x in got)


def test_texts_under_a_repeated_id_are_nodes_of_their_own(spark, docs):
    from retentia.llm import stages

    base = {t: [f"{t}{k}" for k in range(60)] for t in "abc"}
    near = {t: " ".join([*w[:30], "x", *w[31:]]) for t, w in base.items()}
    full = {t: " ".join(w) for t, w in base.items()}
    # 5 holds copies of two families, and one text of no family; 3 holds two texts that link
    rows = [(1, full["a"]), (5, near["a"]), (5, full["b"]), (9, near["b"]), (5, "alone " * 3 + "here"),
            (3, full["c"]), (3, near["c"])]
    got = sorted((x.doc_id, x.n_links, x.class_id) for x in lsh_forest.jaccard_join(docs(rows)).collect())
    assert got == [(1, 1, 1), (3, 1, 3), (3, 1, 3), (5, 0, 5), (5, 1, 1), (5, 1, 5), (9, 1, 5)]
    left = {(x.doc_id, x.text) for x in stages.drop_near_copies(spark, docs(rows), "").collect()}
    assert len(left) == 4 and left >= {(1, full["a"]), (5, full["b"]), (5, "alone " * 3 + "here")}
    assert {i for i, _ in left} == {1, 3, 5}


@pytest.mark.parametrize("blocks", [(8192, 2048), (16, 3)])
def test_bit_sliced_topk_is_exact(spark, blocks):
    r = np.random.default_rng(2)
    rows = [list(map(float, np.round(r.normal(size=6), 1))) for _ in range(90)] + [[0.0] * 6] * 4 + [[5.0, -7.25]]
    data = list(enumerate(rows))
    data += [(1150, [1e30] * 6), (1160, [-3e8, 1.0]), (1163, [2.5e6] * 6), (1167, [1e30] * 6)]
    odd = [(1000, None), (1050, [float("inf")] * 6), (1100, [None] * 6), (None, rows[0])]
    df = (spark.createDataFrame(data + odd, "vec_id long, embedding array<double>")
          .withColumn("score", F.lit("clash")))
    got = [tuple(x) for x in bitslices.top_k(df, F.col("vec_id") % 10 == 0, 5, block_rows=blocks[0],
                                             part_queries=blocks[1]).collect()]
    q = {i: [math.floor(256 * Fraction(x)) for x in v] + [0] * (6 - len(v)) for i, v in data}
    want, top = [], (1 << 63) - 1
    for i in (i for i in q if i % 10 == 0):
        order = sorted((-sum(a * b for a, b in zip(q[i], q[j], strict=True)), j) for j in q if j != i)[:5]
        want += [(i, k + 1, j, max(-top, min(top, -s))) for k, (s, j) in enumerate(order)]
    assert sorted(got) == sorted(want)
    wide = [(1, [1.0, 2.0]), (2, [2e6, 1.0]), (3, [3e6, 0.0]), (4, [1.0, 1.0])]
    df2 = spark.createDataFrame(wide, "vec_id long, embedding array<double>")
    assert [x.vec_id for x in bitslices.top_k(df2, F.col("vec_id") == 1, 3).orderBy("rank").collect()] == [3, 2, 4]
    few = bitslices.top_k(df.filter("vec_id < 3"), F.col("vec_id") == 0, 5).collect()
    assert len(few) == 2
    assert bitslices.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0
