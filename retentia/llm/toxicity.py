"""Toxicity by multiple-instance learning (operator 5).

A document is a bag of sentences. A sentence's score is a logistic function of its
words and word beginnings; the document's score is their noisy-or, the chance that at
least one sentence offends. Only document labels are needed: the gradient of the
noisy-or hands a toxic label to the sentences that explain it, and a clean label to
all. Scored sentences then locate the offence.

Learning uses a bounded sample of labelled rows (``training``); scoring reads every
whole text.

Defined results: null and empty texts have no sentence and score 0; very long texts are
scored whole; an empty table gives no rows; repeated rows score
alike; without both labels in the sample the score is 0 for all; columns beyond id and
text are kept, those with the names of the outputs are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
# Beginnings of words that are features beside the whole word.
PREFIXES = (4, 5, 6, 7)
STEPS, SHRINK, LEAST_EVIDENCE = 400, 1e-4, 6.5
CACHE_WORDS = 200_000


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


@dataclass
class NoisyOr:
    """Weights of words and word beginnings, and the bias of a sentence."""

    weights: dict[str, float]
    bias: float

    def word(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))


def evidence(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Likelihood ratio of a feature's documents being toxic at another rate than all,
    0 where the rate is no higher."""
    total, rate = pos + neg, n_pos / (n_pos + n_neg)

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / expected), 0.0)

    ratio = 2 * (part(pos, total * rate) + part(neg, total * (1 - rate)))
    return np.where(pos > total * rate, ratio, 0.0)


def fit(sample: list[tuple[str, int]], steps: int = STEPS, shrink: float = SHRINK,
        least_evidence: float = LEAST_EVIDENCE) -> NoisyOr:
    """Learn sentence weights from document labels by the noisy-or likelihood.

    Features that no label points to are left out; the others get weights of at least 0
    by proximal gradient steps with an L1 penalty, so that few explain the labels."""
    label = np.array([y for _, y in sample], float)
    if len(set(label)) < 2:
        return NoisyOr({}, -30.0)
    pos, neg = Counter(), Counter()
    for text, y in sample:
        (pos if y else neg).update({f for w in set(WORD.findall(text.lower())) for f in features(w)})
    names = sorted(pos)
    found = evidence(np.array([pos[f] for f in names], float), np.array([neg[f] for f in names], float),
                     int(label.sum()), int(len(label) - label.sum()))
    names = [f for f, e in zip(names, found, strict=True) if e >= least_evidence]
    at = {f: i for i, f in enumerate(names)}
    cols, rows, docs, plain = [], [], [], np.zeros(len(label))
    for d, (text, _) in enumerate(sample):
        for sentence in SENTENCE.findall(text.lower()):
            hit = [at[f] for w in set(WORD.findall(sentence)) for f in features(w) if f in at]
            if hit:
                cols.extend(hit)
                rows.extend([len(docs)] * len(hit))
                docs.append(d)
            else:
                plain[d] += 1  # a sentence of no known feature: the bias alone
    cols, rows, docs = (np.asarray(x, np.int64) for x in (cols, rows, docs))

    def loss(w: np.ndarray, b: float):
        z = np.bincount(rows, w[cols], len(docs)) + b
        total = np.bincount(docs, np.logaddexp(0, z), len(label)) + plain * np.logaddexp(0, b)
        total = np.clip(total, 1e-9, 500)
        value = np.where(label == 1, -np.log(-np.expm1(-total)), total).mean() + shrink * w.sum()
        return value, z, total

    w, b, step = np.zeros(len(names)), -4.0, 8.0
    value, z, total = loss(w, b)
    for _ in range(steps):
        hand = np.where(label == 1, -1 / np.expm1(total), 1.0) / len(label)
        g = hand[docs] / (1 + np.exp(-np.clip(z, -500, 500)))
        gw = np.bincount(cols, g[rows], len(names))
        gb = g.sum() + (hand * plain).sum() / (1 + np.exp(-b))
        while step > 1e-6:
            trial = np.maximum(w - step * (gw + shrink), 0), b - np.clip(step * gb, -0.5, 0.5)
            made = loss(*trial)
            if made[0] <= value:
                break
            step /= 2
        else:
            break
        (w, b), (value, z, total), step = trial, made, step * 1.5
    kept = np.flatnonzero(w > 1e-6)
    return NoisyOr({names[i]: float(w[i]) for i in kept}, float(b))


class _Scores(dict):
    """A word's weight, kept for the words seen first."""

    def __init__(self, model: NoisyOr) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        made = self.model.word(word)
        if len(self) < CACHE_WORDS and len(word) <= 32:
            self[word] = made
        return made


def score_text(text: str, words: _Scores, threshold: float = 0.5
               ) -> tuple[float, list[tuple[int, int, float]]]:
    """The document's score and its offending sentences (start, end, score)."""
    base = float(np.logaddexp(0, words.model.bias))
    total, offending = 0.0, []
    lower = text.lower()
    if len(lower) != len(text):  # a few letters change length; keep offsets those of the text
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for m in SENTENCE.finditer(lower):
        z = sum(map(words.__getitem__, set(WORD.findall(m[0]))))
        if z:
            z += words.model.bias
            total += float(np.logaddexp(0, z))
            p = 1 / (1 + np.exp(-z)) if z > -500 else 0.0
            if p >= threshold:
                offending.append((m.start(), m.end(), float(p)))
        else:
            total += base
    return float(-np.expm1(-total)), offending


def score(docs: DataFrame, model: NoisyOr, text_col: str = "text", threshold: float = 0.5
          ) -> DataFrame:
    """Adds ``score`` (0 to 1), ``predicted`` and ``offending``, the sentences (code points,
    end exclusive) whose own score reaches ``threshold``."""
    made = ["score", "predicted", "offending"]
    keep = [c for c in docs.columns if c not in made]
    span = T.StructType([T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType()),
                         T.StructField("score", T.DoubleType())])
    schema = T.StructType([*docs.select(*[f"`{c}`" for c in keep]).schema,
                           T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()),
                           T.StructField("offending", T.ArrayType(span))])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Scores(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [score_text(t or "", words, threshold)
                         for t in part.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep],
                     pa.array([s for s, _ in found], pa.float64()),
                     pa.array([int(s >= 0.5) for s, _ in found], pa.int32()),
                     pa.array([[dict(zip(("start", "end", "score"), x, strict=True)) for x in o]
                               for _, o in found], spans)], names=[*keep, *made])

    return docs.mapInArrow(run, schema)
