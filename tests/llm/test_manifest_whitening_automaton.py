"""Merkle manifest, whitening and the token automaton: brute force, libraries, edge cases."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from fixtures import SF_SMALL, docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from retentia.llm import automaton, merkle, queries, whitening

# ---- merkle ----------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(hashes):
    made = [hashes]
    while len(made[-1]) > 1:
        made.append([sha(*made[-1][i:i + 8]) for i in range(0, len(made[-1]), 8)])
    return made


def path(tree, i):
    made = []
    for level in tree[:-1]:
        a = i - i % 8
        made.append((level[a:i], level[i + 1:a + 8]))
        i //= 8
    return made


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root) of every row."""
    def leaf(d, text):
        return sha(*map(field, (d["doc_id"], d["source"], d["lang"], d["n_chars"], text)))

    groups = defaultdict(list)
    for d in rows:
        groups[d["lang"]].append((d["doc_id"], leaf(d, d["text"]), d))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = levels([x[1] for x in groups[g]])
    top = levels([trees[g][-1][0] for g in langs])
    made = []
    for k, g in enumerate(langs):
        for i, (doc_id, h, d) in enumerate(groups[g]):
            proof, text = path(trees[g], i) + path(top, k), d["text"]
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            end = leaf(d, text)
            for before, after in proof:
                end = sha(*before, end, *after)
            made.append((doc_id, h, trees[g][-1][0], top[-1][0],
                         sha(*(x for before, after in proof for x in before + after)), end))
    return made


def rows_of(df, tmp_path):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root)
            for r in queries.op13_merkle_manifest(df.sparkSession, str(tmp_path)).collect()]


KIND = "doc_id long, text string, lang string, source string, n_chars long, leaf string, g int"


def test_manifest_equals_the_plain_tree(spark, tmp_path):
    r = np.random.default_rng(5)
    ids = [*range(-20, 30), *r.integers(-1 << 62, 1 << 62, 200).tolist(), *range(65500, 65600)]
    rows = [(i, f"Text {i} ÀB", ["en", "zé", None, "fr", ""][i % 5], "s" if i % 3 else None, i % 7 or None, "x", 1)
            for i in ids]
    rows += [(None, "Null Id", "en", "s", 1, "x", 1), (None, None, "en", None, None, "x", 1),
             (5, "Text 5 again", "en", "s", 1, "x", 1), (5, "Text 5 again", "en", "s", 1, "x", 2),
             (7, "", None, "s", 0, "x", 1), (9, "A" * 300_000, "zé", "s", 300_000, "x", 1), (11, "X", "alone", "s", 1, "x", 1)]
    df = spark.createDataFrame(rows, KIND)
    want = brute_manifest([d.asDict() for d in df.collect()])
    assert sorted(rows_of(df, tmp_path), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("n", [1, 8, 9])
def test_manifest_of_few_rows(spark, tmp_path, n):
    df = spark.createDataFrame([(i, "AbC", "en", "s", 3, "x", 1) for i in range(n)], KIND)
    assert sorted(rows_of(df, tmp_path)) == sorted(brute_manifest([d.asDict() for d in df.collect()]))


def test_manifest_of_nothing_and_over_several_rounds(spark, tmp_path, monkeypatch):
    empty = spark.createDataFrame([], KIND)
    assert merkle.manifest(empty, F.lit(None).cast("string")).count() == 0
    # a group of three rounds of the real size: 4096 slots an array, 2 groups
    df = spark.range(9000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"),
                                  F.when(F.col("id") % 1000 == 0, "b").otherwise("a").alias("lang"),
                                  F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    got = rows_of(df, tmp_path)
    assert sorted(got) == sorted(brute_manifest([d.asDict() for d in df.collect()]))
    assert sum(g[5] == g[3] for g in got) == len(got)  # digits have no case


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(0, merkle.RUN - 1), st.integers(1, 9), min_size=1, max_size=300),
       st.booleans())
def test_bitmaps_round_trip(counts, dense):
    if dense:
        counts = dict.fromkeys(range(0, merkle.RUN, 2), 1) | counts
    places = np.array(sorted(counts))
    n = np.array([counts[p] for p in places.tolist()])
    got = merkle.unpacked_run(merkle.packed_run(places, n))
    assert (got[0] == places).all() and (got[1] == n).all()


# ---- whitening -------------------------------------------------------------------


def whitened(spark, vectors, **options):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("q", F.lit("clash"))
    return whitening.whiten(df, **options).collect()


def check_whitening(got, vectors, components=4):
    x = {i: np.floor(256 * np.array(v)) for i, v in vectors}
    fit = np.unique(np.stack(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    e, q = np.linalg.eigh((fit - sums / n).T @ (fit - sums / n) / n)
    e, q = e[::-1], q[:, ::-1]
    assert len(got) == components * len(vectors)
    for c in range(components):
        own = {r.vec_id: r for r in got if r.component == c + 1}
        want = np.array([(x[i] - sums / n) @ q[:, c] / e[c] ** 0.5 for i in own])
        have = np.array([own[i].whitened for i in own])
        assert np.abs(have - want * np.sign(have @ want)).max() < 1e-8
        for i, r in own.items():
            assert r.n == n and abs(r.explained - e[c] / e.sum()) < 1e-9 and r.identity_error < 1e-9
            assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums, strict=True))


def test_whitening_equals_the_eigenvectors(spark):
    r = np.random.default_rng(3)
    base = (r.normal(size=(60, 9)) @ np.diag([9, 7, 5, 4, 3, 2, 1, 1, 0.5])).tolist()
    vectors = list(enumerate(base + base[:20]))  # repeated vectors count once in the fit
    odd = [(500, None), (501, [float("nan")] * 9), (502, [None] * 9), (503, [float("inf")] * 9)]
    check_whitening(whitened(spark, vectors + odd), vectors)


def test_whitening_of_equal_deviations_and_few_vectors(spark):
    # every axis has the same deviation: all four components are found, in some rotation
    got = whitened(spark, [(i, [(1.0 if i % 2 else -1.0) * (i // 2 == k) for k in range(5)]) for i in range(10)])
    y = np.zeros((10, 4))
    for r in got:
        y[r.vec_id, r.component - 1] = r.whitened
    assert len(got) == 40 and np.abs(y.T @ y / 10 - np.eye(4)).max() < 1e-9
    assert {r.component for r in whitened(spark, [(1, [1.0, 2.0, 3.0]), (None, [2.0, 1.0, 0.0]), (1, [2.0, 1.0, 0.0])])} == {1}
    assert whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert whitened(spark, [(1, None)]) == []
    wide = [(i, [1e7 * ((i * k) % 7 - 3), float(i)]) for i, k in enumerate(range(40))]
    own = {r.vec_id: r.deviation for r in whitened(spark, wide) if r.component == 1}
    x = {i: [int(np.floor(256 * c)) for c in v] for i, v in wide}
    sums = [sum(v[d] for v in set(map(tuple, x.values()))) for d in range(2)]
    n = len(set(map(tuple, x.values())))
    for i, d in own.items():
        want = sum((n * c - s) ** 2 for c, s in zip(x[i], sums, strict=True))
        assert d == (want if want < 1 << 63 else None)


def test_whitening_query_reads_every_row(spark):
    got = queries.op12_golub_kahan_whitening(spark, SF_SMALL).collect()
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    check_whitening(got, [(r.vec_id, [float(x) for x in r.embedding]) for r in rows])


# ---- automaton -------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return automaton.Coder(f.read())


ODD = ["", "Don't we'LL 12 3rd <|endoftext|> x <|startoftext|><|endoftext|", "É́ İSTANBUL ΣΑΣ ß ﬁ x y \x1c z\x85q",
       "a\tb\rc's", "b" * 5000, "aaaaaaa aaaa", "  a \n\n b ", "日本語 한국 🙂", "hello <|endoftext|> x", "</w> < / w >"]


def plain_merges(merges, word):
    """Merges in order of priority, each from left to right."""
    for u, v in merges:
        i, made = 0, []
        while i < len(word):
            if i + 1 < len(word) and (word[i], word[i + 1]) == (u, v):
                made.append(u + v)
                i += 2
            else:
                made.append(word[i])
                i += 1
        word = made
    return word


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_automaton_equals_the_merges(data):
    labels, merges = list("abc"), []
    for _ in range(data.draw(st.integers(0, 8))):
        pair = (data.draw(st.sampled_from(labels)), data.draw(st.sampled_from(labels)))
        if "".join(pair) not in labels:
            merges.append(pair)
            labels.append("".join(pair))
    vocabulary = {x: i for i, x in enumerate(labels)}
    made = automaton.Automaton(vocabulary, merges)
    word = data.draw(st.text("abc", min_size=1, max_size=14))
    assert [labels[i] for i in made.path(list(word))] == plain_merges(merges, list(word))


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("abeinorst'S 1é!\n")), max_size=60))
def test_coder_equals_the_library(coder, text):
    want = coder.splitter.library.encode(text, add_special_tokens=False).ids
    ids = coder.ids(text)
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert coder.text(ids) == coder.splitter.library.decode(want, skip_special_tokens=False)


def test_automaton_over_a_table(spark, docs, coder):  # noqa: F811
    definition = automaton.share_definition(spark, public_tokenizers.path("word_bpe_49k.json"))
    texts = [*ODD, None, "word " * 30_000, ODD[1]]
    df = docs([(i, t) for i, t in enumerate(texts)], extra="token_ids").withColumn("a.b", F.lit(1))
    made = automaton.encode(df, definition, decoded_col="decoded")
    library = coder.splitter.library
    for r in made.collect():
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.token_ids, "<u4").tolist() == want and r["a.b"] == 1
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    again = automaton.decode(made.drop("decoded"), definition).collect()
    assert {r.doc_id: r.decoded for r in again} == {r.doc_id: r.decoded for r in made.collect()}
    assert automaton.encode(df.limit(0), definition).count() == 0
    with pytest.raises(ValueError):
        automaton.Automaton({"a": 0, "b": 1, "ab": 2}, [("a", "b"), ("a", "b")])


def test_automaton_query_equals_the_library(spark, coder):
    got = {r.doc_id: r for r in queries.op11_merge_automaton(spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(rows)
    for d in rows:
        ids = np.array(coder.splitter.library.encode(d.text or "", add_special_tokens=False).ids, "<u4")
        text = coder.splitter.library.decode(ids.tolist(), skip_special_tokens=False)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
