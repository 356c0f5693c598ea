"""PII, mixing, classifiers, pipeline stages: brute force, held-out accuracy, edge cases."""

import re

import numpy as np
import pytest
from fixtures import SF_SMALL, docs  # noqa: F401
from pyspark.sql import functions as F
from retentia.llm import mixing, pii, quality, stages, toxicity, training

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    odd = [int(c) for c in digits[-1::-2]]
    even = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def kept(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind != "ip" or all(int(x) < 256 for x in match.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base_spans(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items()
                    for m in re.finditer(p, text or "") if kept(k, m[0]))


def test_pii_base_matches_found_words_and_redaction(docs):
    texts = ["a@b.c_d@e.f 1.2.3.4.5.6.7.8 300.1.1.1 001.02.3.255", "é😀 joe@x.com, +1 (262) 555-3752 4469117213011744 6",
             "", None, "a@b a.b@c.d.e@f.g", "+" * 5 + "1" * 20 + " +12 34 56 789", " 4111 1111-1111-1111 2",
             "4111-1111 1111 1111", "@.@ 5 +1", " 4111  1111 1111 1111 1.2.3.4-5.6.7.8.9 a@b..c a@-.-.", "0 0 \u0085 x9"]
    texts += [f"The member contact address: u{i}x{i}@mail.org today" for i in range(6)]
    texts += ["the member contact address: QX99817A, right", "another thing: QX99817A", "address: QX99817B end"]
    rows = list(enumerate(texts))
    long = [(900, "9" * 150_000 + " x@y.zz"), (901, "a" * 150_000 + "@" + "b" * 50_000)]
    got = {r.doc_id: r for r in pii.find(docs([*rows, *long, (902, "1.1.1.1"), (902, "1.1.1.1"), (None, "2.2.2.2")]))
           .select("doc_id", pii.listed(F.col("base")).alias("base"), pii.listed(F.col("spans")).alias("spans")).collect()}
    for i, t in rows:
        assert got[i].base == base_spans(t), t
    assert got[900].base == "email:150001:150007" and got[901].base == ""
    at = texts.index("the member contact address: QX99817A, right")
    assert got[at].spans == "email:28:36" and got[at + 1].spans == ""
    clean = {r.doc_id: r for r in pii.redact(docs(rows, extra="keep")).collect()}
    assert clean[0].text == "<EMAIL><EMAIL> <IP>.<IP> 300.1.1.1 <IP>" and clean[0].keep == "extra"
    assert clean[at].text == "the member contact address: <EMAIL>, right" and clean[3].text is None
    assert pii.find(docs(rows).limit(0)).count() == 0


def test_mix_targets_and_copies(spark):
    r = np.random.default_rng(1)
    rows = [(i, "w " * int(n) + ["", "\x1cx", "\x0b"][i % 3], s) for i, (n, s) in enumerate(
        zip(r.integers(0, 400, 600), r.choice(["a", "b", "c", "d", "e"], 600, p=[.6, .2, .1, .09, .01]), strict=True))]
    rows += [(1000, None, "z"), (1001, "", "z"), (1002, "one two", None), (1003, "x", None), (1003, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = [x.asDict() for x in mixing.systematic_copies(df).collect()]
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, open_, target = sum(sizes.values()), set(order), {}
    while open_:  # share by weight, stop at three times the size, share the excess again
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] >= 3 * sizes[s]}
        target |= {s: 3.0 * sizes[s] for s in above} if above else share
        open_ = open_ - above if above else set()
    for x in got:
        assert x["source_size"] == sizes[x["source"]] and x["target"] == pytest.approx(target[x["source"]])
        assert x["taken"] == x["copies"] * x["size"] and x["copies"] <= 3
    for s in order:
        own = [x for x in got if x["source"] == s]
        slack = max((x["size"] for x in own), default=0)
        assert abs(sum(x["taken"] for x in own) - target[s]) <= slack + 0.05 * target[s]
    again = [x.asDict() for x in mixing.systematic_copies(df.repartition(7)).collect()]
    key = lambda x: tuple(map(str, x.values()))
    assert sorted(got, key=key) == sorted(again, key=key)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(x["copies"] for x in got)
    assert mixing.mix(df.limit(0)).count() == 0


def labelled(n, seed):
    r = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in ("tor", "len", "mab", "qui") for b in ("da", "ne", "sil", "por", "ume")]
    for i in range(n):
        text = " ".join(" ".join(r.choice(words, 8)) + "." for _ in range(int(r.integers(1, 30))))
        if bad := int(i % 4 == 0):
            cut = int(r.integers(0, text.count(".") or 1))
            parts = text.split(". ")
            parts.insert(min(cut, len(parts)), "you vile " + str(r.choice(["grubface", "grubling", "snottard"])))
            text = ". ".join(parts)
        yield i, text, bad


def test_toxicity_learns_from_documents_and_locates_sentences(docs):
    sample, test = list(labelled(400, 1)), list(labelled(200, 2))
    model = toxicity.fit([(t, y) for _, t, y in sample])
    extra = [(500, None), (501, ""), (502, "..\n.."), (503, "Hello. İt: you VILE grubface!  yes."), (504, "tor " * 100_000)]
    made = {r.doc_id: r for r in toxicity.score(docs([(i, t) for i, t, _ in test] + extra, extra="predicted"), model).collect()}
    assert np.mean([made[i].predicted == y for i, _, y in test]) >= 0.97
    text = extra[3][1]
    assert [text[s.start:s.end].strip() for s in made[503].offending] == ["İt: you VILE grubface"]
    assert all(made[i].score == 0 for i in (500, 501)) and made[504].predicted == 0
    none = toxicity.score(docs([(1, "vile")]), toxicity.fit([("vile", 1)])).first()
    assert none.predicted == 0 and toxicity.fit([]).weights == {}
    assert toxicity.score(docs([(1, "a")]).limit(0), model).count() == 0


def test_quality_learns_from_documents(docs):
    def rows(n, seed):
        for i, text, _ in labelled(n, seed):
            words = text.split()
            if i % 3 == 0:
                words = [w for w in words[:6] for _ in range(12)] if i % 2 else [w + "###" for w in words]
            yield i, " ".join(words), int(i % 3 != 0)

    model = quality.fit([(t, y) for _, t, y in rows(300, 3)])
    test = list(rows(150, 4))
    extra = [(500, None), (501, ""), (502, " \n "), (503, "x" * 200_000), (504, "a b " * 50_000)]
    made = {r.doc_id: r for r in quality.score(docs([(i, t) for i, t, _ in test] + extra), model).collect()}
    assert np.mean([made[i].predicted == y for i, _, y in test]) >= 0.95
    assert all(0 <= r.score <= 1 for r in made.values()) and made[500].score == made[501].score
    assert quality.score(docs([(1, "a")]), quality.fit([])).first().score == 1.0
    assert quality.score(docs([(1, "a")]).limit(0), model).count() == 0


def test_only_rows_that_are_not_held_out_teach(spark, docs):
    import zlib
    rows = [(i, f"text {i}") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = training.labelled_sample(docs(rows), labels, "toxic")
    ids = {int(t.split()[1]) for t, _ in got}
    assert ids == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}
    assert len(training.labelled_sample(docs(rows), labels, "toxic", limit=10)) == 10
    assert training.labelled_sample(docs(rows), labels.limit(0), "toxic") == []


def test_stages_decide_as_their_operators(spark):
    import corpus_pipeline
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "a", 1), (2, text + " end", "en", "a", 1), (3, "other words here now", "en", "b", 1),
            (4, "call +1 (262) 555-3752 or a@b.org", "en", "b", 1), (4, "call +1 (262) 555-3752 or a@b.org", "en", "b", 1),
            (5, None, None, None, None), (None, text, "en", "a", 1)]
    docs = spark.createDataFrame(rows, columns)
    left = stages.drop_near_copies(spark, docs, SF_SMALL)
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 3, 4, 5] and left.columns == docs.columns
    clean = {r.doc_id: r for r in stages.redact_pii(spark, docs, SF_SMALL).collect()}
    assert clean[4].text == "call <PHONE> or <EMAIL>" and clean[4].n_chars == 23 and clean[5].text is None
    toxic = stages.reject_toxic(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), SF_SMALL)
    assert toxic.columns == docs.columns and 150 <= toxic.count() <= 200
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "reject_toxic", "drop_near_copies", "redact_pii", "mix_sources", "encode_bytes"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
