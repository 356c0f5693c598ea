"""The bootstrap of personal data against a plain loop, large groups of near copies, and the whole pipeline."""

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from fixtures import SF_SMALL, docs  # noqa: F401
from test_text_operators import base_spans

from pyspark.sql import functions as F
from retentia.llm import byte_bpe, lsh_forest, mixing, pii, stages, toxicity, training

MARK, BEGIN = "0", "^"


def plain_bootstrap(texts):
    """Spans of texts of words between single blanks: mails are seeds, words with a digit identifiers."""
    seen, totals = [], defaultdict(int)   # (text, start, end, instance, is seed, patterns)
    for t, text in enumerate(texts):
        words, at, marked = text.split(" "), 0, [BEGIN, BEGIN]
        marked += [MARK if any(c.isdigit() or c == "@" for c in w) else w.lower() for w in words]
        for i, w in enumerate(words):
            one, two = marked[i + 1], marked[i]
            patterns = [] if one in (MARK, BEGIN) else [(one,), (two, one)]
            for p in patterns:
                totals[p] += 1
            seed = "@" in w
            if marked[i + 2] == MARK and (seed or len(w) >= pii.LEAST_CHARS):
                seen.append((t, at, at + len(w), w, seed, patterns))
            at += len(w) + 1
    edges = defaultdict(int)
    for _, _, _, instance, _, patterns in seen:
        for p in patterns:
            edges[p, instance] += 1
    seeds = {s[3] for s in seen if s[4] and s[5]}
    trusted, last = dict.fromkeys(seeds, 1.0), (0, 0.0)
    while True:
        held, support = defaultdict(float), defaultdict(int)
        for (p, instance), n in edges.items():
            if instance in trusted:
                held[p] += trusted[instance] * n
                support[p] += 1
        scores = {p: min(1.0, h / totals[p]) for p, h in held.items() if support[p] >= pii.MIN_SEEDS}
        scores = {p: c for p, c in scores.items() if c >= pii.CONFIDENT}
        now = (len(scores), sum(scores.values()))
        if not scores or (now[0] == last[0] and now[1] - last[1] < pii.SETTLED):
            break
        last, missing = now, defaultdict(lambda: 1.0)
        for p, instance in edges:
            if p in scores and instance not in seeds:
                missing[instance] *= 1 - scores[p]
        trusted = dict.fromkeys(seeds, 1.0) | {i: 1 - m for i, m in missing.items()}
    return [",".join(f"email:{a}:{b}" for t, a, b, _, seed, patterns in seen
                     if t == k and (seed or any(p in scores for p in patterns))) for k in range(len(texts))]


def spans_of(docs, texts):
    got = pii.find(docs(list(enumerate(texts)))).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()
    return [s for _, s in sorted((r.doc_id, r.s) for r in got)]


def test_found_identifiers_induce_patterns(docs):  # noqa: F811
    texts = [f"my mailbox u{i}x@ex.org thanks" for i in range(6)]
    texts += [f"her mailbox QX9981{i}A too" for i in range(3)]
    texts += [f"staff badge number QX9981{i}A seen" for i in range(3)]
    texts += ["staff badge number ZT44556B seen", "the room 12345678 is open", "a lone ZT99999B here", "number 12 is short"]
    got = spans_of(docs, texts)
    assert got == plain_bootstrap(texts)
    assert got[12] == "email:19:27" and got[9] == "email:19:27" and not any(got[13:])


def test_bootstrap_equals_the_plain_loop_on_random_texts(docs):  # noqa: F811
    r = np.random.default_rng(17)
    plain = ["mail", "badge", "code", "is", "the", "ref"]
    ids = [f"ID{i}X{i:04d}" for i in range(8)]
    texts = []
    for _ in range(80):
        words = []
        for _ in range(int(r.integers(2, 9))):
            words.append(str(r.choice(plain)))
            if words[-1] == "mail" and r.random() < 0.7:
                words.append(f"p{r.integers(9)}@x.org" if r.random() < 0.75 else str(r.choice(ids)))
            elif words[-1] in ("badge", "code") and r.random() < 0.8:
                words.append(str(r.choice(ids)))
        texts.append(" ".join(words))
    want = plain_bootstrap(texts)
    assert spans_of(docs, texts) == want
    assert sum(w.count("email") for w in want) > sum(t.count("@") for t in texts)


def test_a_large_group_of_near_copies_is_one_class(spark, docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(lsh_forest, "BIG", 20)
    monkeypatch.setattr(lsh_forest, "FIRST_ROWS", 16)
    r = np.random.default_rng(23)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(90):     # 3 or 16 words of the base changed: near copies, and copies of these alone
        words, n = list(base), 3 if i % 9 else 16
        for k in r.choice(150, n, replace=False):
            words[k] = f"x{i}y{k}"
        rows.append((i, " ".join(words)))
    other = [f"v{i}" for i in range(120)]
    rows += [(200 + i, " ".join([*other[:i], "z", *other[i + 1:]])) for i in range(0, 60, 2)]
    rows += [(400, " ".join(base[:75] + other[:75])), (401, "short")]
    sets = [set(lsh_forest.shingles(t).tolist()) for _, t in rows]
    links = {rows[i][0]: sum(i != j and len(a & b) / len(a | b) >= 0.8 for j, b in enumerate(sets))
             for i, a in enumerate(sets)}
    for block_rows in (1500, 7):
        got = {x.doc_id: x.n_links for x in lsh_forest.jaccard_join(docs(rows), block_rows=block_rows).collect()}
        assert got == links
    assert max(links.values()) > 20


@pytest.fixture(scope="module")
def run_rows(spark):
    import corpus_pipeline

    return corpus_pipeline.run(spark, SF_SMALL).collect()


def test_pipeline_equals_its_stages_done_plainly(spark, run_rows):
    documents = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = toxicity.fit(training.labelled_sample(documents, labels, "toxic"))
    words = toxicity._Scores(model)
    left = [d for d in documents.collect() if toxicity.score_text(d.text or "", words)[0] < 0.5]
    # one document of each group of linked ones, by all pairs
    sets = [set(lsh_forest.shingles(d.text or "").tolist()) for d in left]
    root = list(range(len(left)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= 0.8:
                root[find(i)] = find(j)
    smallest = defaultdict(lambda: 1 << 62)
    for i, d in enumerate(left):
        smallest[find(i)] = min(smallest[find(i)], d.doc_id)
    left = [d for i, d in enumerate(left) if smallest[find(i)] == d.doc_id]
    assert 100 < len(left) < documents.count()

    def redacted(text):  # no context is confident in these tables: base spans alone
        spans = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in base_spans(text).split(",") if s))
        made, at = "", 0
        for a, b, kind in spans:
            if a >= at:
                made += text[at:a] + pii.REDACTED[kind]
            at = max(at, b)
        return made + text[at:]

    clean = {d.doc_id: None if d.text is None else redacted(d.text) for d in left}
    kept = spark.createDataFrame([(d.doc_id, clean[d.doc_id], d.lang, d.source, d.n_chars) for d in left], documents.schema)
    copies = {r.doc_id: r.taken // r["size"] for r in mixing.systematic_copies(kept).collect() if r["size"]}
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"):
        ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = defaultdict(list)
    for r in run_rows:
        got[r.doc_id].append(r)
    assert {k: len(v) for k, v in got.items() if copies.get(k)} == {k: n for k, n in copies.items() if n}
    for doc_id, rows in got.items():
        ids = library.encode_ordinary(clean[doc_id] or "")
        assert all(r.token_ids == ids and r.n_tokens == len(ids) for r in rows)
        assert all(r.n_bytes == len((clean[doc_id] or "").encode()) for r in rows)


def test_stages_keep_columns_of_any_name(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, _text string, cls int, n_tokens int"
    rows = [(1, "a b c d e f", "en", "s", 11, 7, "x", 1, 5), (1, "a b c d e f", "fr", "t", 11, 8, "y", 2, 6),
            (2, None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, kind)
    left = stages.drop_near_copies(spark, df, SF_SMALL)
    assert left.columns == df.columns
    assert sorted((r.doc_id, r["a.b"], r["_text"]) for r in left.collect()) == [(1, 7, "x"), (2, None, None)]
    made = stages.encode_bytes(spark, df, SF_SMALL)
    assert made.columns == ["doc_id", "lang", "source", "n_chars", "a.b", "_text", "cls", "token_ids", "n_tokens", "n_bytes"]
    assert {r["a.b"]: r.n_bytes for r in made.collect()} == {7: 11, 8: 11, None: 0}
    assert stages.reject_toxic(spark, df, SF_SMALL).columns == df.columns


def test_near_copies_leave_only_the_decision_on_disk(spark, monkeypatch, tmp_path):
    from retentia.llm import common
    monkeypatch.setattr(common, "ensure_checkpoint_dir", lambda spark: str(tmp_path))
    words = [f"word{k}" for k in range(60)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), "a text that stands for itself " * 5]
    df = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in enumerate(texts)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    left = stages.drop_near_copies(spark, df, SF_SMALL)
    names = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert names == {"near-copies", "repeated-rows"}
    assert [r.doc_id for r in left.orderBy("doc_id").collect()] == [0, 2]
    tables = [common.written(df, "outer")]
    made = common.distilled(spark, lambda: common.written(
        common.distilled(spark, lambda: common.written(df, "inner").limit(2), "middle"), "last"), "made")
    assert made.count() == 2 and tables[0].count() == 3
    assert {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()} - names == {"outer", "made"}
    with pytest.raises(ZeroDivisionError):
        common.distilled(spark, lambda: common.written(df, "lost") and 1 / 0, "never")
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("lost")]


def test_redact_writes_a_text_once(spark, monkeypatch):
    tables = {}

    def spied(df, name):
        tables[name] = df.schema
        return written(df, name)

    written = pii.written
    monkeypatch.setattr(pii, "written", spied)
    df = spark.createDataFrame([(1, "mail a@b.cd now", "x"), (None, None, None)], "doc_id long, text string, `a.b` string")
    made = pii.redact(df)
    kept = tables["pii-spans"]["keep"].dataType
    assert kept.names == ["doc", "text"] and kept["doc"].dataType.names == ["doc_id", "a.b"]
    assert made.columns == df.columns
    assert sorted(map(tuple, made.collect()), key=str) == [(1, "mail <EMAIL> now", "x"), (None, None, None)]
    assert [r.text for r in pii.redact(df.select("text")).filter("text IS NOT NULL").collect()] == ["mail <EMAIL> now"]
