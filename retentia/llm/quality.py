"""Quality by attention-based multiple-instance learning (operator 8).

A document is a bag of passages of PASSAGE_WORDS words. Every passage is described by
its make-up (character classes, word lengths, repetition) and encoded by a small
network; gated attention, learned from document labels, weighs the passages, and the
weighted sum of encodings is scored.

Learning uses a bounded sample of labelled rows (``training``); scoring encodes every
passage of every whole text.

Defined results: null and empty texts are one passage without words; very long texts are read
whole, as more passages; an empty table gives no rows; repeated rows
score alike; with one label only in the sample its value is the score of all, without
any label the score is 1; columns beyond id and text are kept, those with the names of
the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from retentia.llm.training import Adam

PASSAGE_WORDS = 64
HIDDEN, GATE = 12, 6
STEPS, RATE, SEED = 300, 0.03, 7
KEEP_AT = 0.3

# Character classes: 0 white space, 1 lower-case letter, 2 upper-case letter, 3 digit,
# 4 sentence punctuation, 5 other symbol, 6 line end.
N_CLASSES = 7
_POSITIONS = np.random.default_rng(SEED).integers(1, 1 << 62, 256, dtype=np.uint64) | np.uint64(1)


def _class_table() -> np.ndarray:
    table = np.full(1 << 16, 5, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c == "\n":
            table[i] = 6
        elif c.isspace():
            table[i] = 0
        elif c.isupper():
            table[i] = 2
        elif c.isalpha():
            table[i] = 1
        elif c.isdigit():
            table[i] = 3
        elif c in ".,;:!?'\"-()":
            table[i] = 4
    return table


CLASSES = _class_table()


def passages(text: str) -> np.ndarray:
    """One row of make-up figures for each passage of the whole text."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kinds = CLASSES[np.minimum(codes, 0xFFFF)]
    solid = (kinds != 0) & (kinds != 6)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]])))
    starts, ends = edge[::2], edge[1::2]
    n = len(starts)
    if n == 0:
        return np.zeros((1, N_FIGURES), np.float32)
    n_bags = -(-n // PASSAGE_WORDS)
    first = starts[::PASSAGE_WORDS]
    sizes = np.diff(np.append(first, len(codes)))
    bag_of_char = np.repeat(np.arange(n_bags), sizes)
    own = kinds[first[0]:].astype(np.int64)
    counts = np.bincount(bag_of_char * N_CLASSES + own, minlength=n_bags * N_CLASSES
                         ).reshape(n_bags, N_CLASSES).astype(np.float32)
    chars = np.maximum(counts.sum(1), 1)
    length = (ends - starts).astype(np.float32)
    # a word's hash: its code points, each times a constant of its place in the word
    inside = np.flatnonzero(solid)
    place = inside - np.repeat(starts, ends - starts)
    mixed = (codes[inside].astype(np.uint64) + np.uint64(7)) * _POSITIONS[place % 256]
    words = np.add.reduceat(mixed, np.concatenate([[0], np.cumsum(ends - starts)[:-1]]))
    pad = n_bags * PASSAGE_WORDS - n
    filled = np.minimum(np.full(n_bags, PASSAGE_WORDS), n - PASSAGE_WORDS * np.arange(n_bags))
    filled = filled.astype(np.float32)

    def table(values, fill):
        return np.concatenate([values, np.full(pad, fill, values.dtype)]).reshape(n_bags, -1)

    grid, lengths = table(words, 0), table(length, 0)
    mean = lengths.sum(1) / filled
    spread = np.sqrt(np.maximum((lengths ** 2).sum(1) / filled - mean ** 2, 0))
    real = np.arange(PASSAGE_WORDS)[None, :] < filled[:, None]
    next_real = real[:, 1:]
    same = ((grid[:, 1:] == grid[:, :-1]) & next_real).sum(1) / filled
    pairs = grid[:, 1:] * np.uint64(0x9E3779B97F4A7C15) + grid[:, :-1]
    distinct, most = _repeats(grid, real)
    distinct2, _ = _repeats(pairs, next_real)
    last = CLASSES[np.minimum(codes[ends - 1], 0xFFFF)]
    ends_symbol = (table((last == 5).astype(np.float32), 0)).sum(1) / filled
    lone = (table(((length <= 2) & (last == 5)).astype(np.float32), 0)).sum(1) / filled
    short = ((lengths <= 3) & real).sum(1) / filled
    long = ((lengths > 12) & real).sum(1) / filled
    return np.column_stack([
        counts / chars[:, None], mean / 10, spread / 5, same, distinct / filled, most / filled,
        distinct2 / np.maximum(filled - 1, 1), ends_symbol, lone, short, long,
        np.log1p(filled) / 4, np.full(n_bags, np.log1p(n) / 8)]).astype(np.float32)


N_FIGURES = N_CLASSES + 12


def _repeats(values: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the most frequent one, in each row."""
    rows, width = values.shape
    marked = np.sort(np.where(real, values | np.uint64(1), np.uint64(0)), axis=1)
    fresh = np.ones_like(marked, bool)
    fresh[:, 1:] = marked[:, 1:] != marked[:, :-1]
    run_start = np.maximum.accumulate(np.where(fresh, np.arange(width)[None, :], 0), axis=1)
    run = (np.arange(width)[None, :] - run_start + 1) * (marked != 0)
    return (fresh & (marked != 0)).sum(1), run.max(1) if width else np.zeros(rows)


@dataclass
class AttentionModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def score(self, bag: np.ndarray) -> tuple[float, np.ndarray]:
        """A bag's score and its passages' attention."""
        if self.constant is not None:
            return self.constant, np.full(len(bag), 1 / len(bag))
        x = (bag - self.mean) / self.scale
        h, a, logit = _forward(self.weights, x, np.zeros(len(bag), np.int64), 1)[:3]
        return float(1 / (1 + np.exp(-np.clip(logit[0], -500, 500)))), a


def _forward(w: dict, x: np.ndarray, bag: np.ndarray, n: int):
    h = np.tanh(x @ w["E"] + w["e"])
    v, u = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    raw = (v * u) @ w["a"]
    top = np.full(n, -np.inf)
    np.maximum.at(top, bag, raw)
    ex = np.exp(raw - top[bag])
    a = ex / np.bincount(bag, ex, n)[bag]
    z = np.column_stack([np.bincount(bag, a * h[:, k], n) for k in range(h.shape[1])])
    return h, a, z @ w["c"] + w["b"], z, v, u


def fit(sample: list[tuple[str, int]], steps: int = STEPS, rate: float = RATE,
        seed: int = SEED) -> AttentionModel:
    """Learn encoding, gated attention and scorer together from document labels."""
    labels = {y for _, y in sample}
    if len(labels) < 2:
        return AttentionModel(np.zeros(1), np.ones(1), {}, float(max(labels, default=1)))
    bags = [passages(text) for text, _ in sample]
    bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    x = np.concatenate(bags).astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x, y, n = (x - mean) / scale, np.array([y for _, y in sample], float), len(sample)
    r = np.random.default_rng(seed)
    w = {"E": r.normal(0, 0.3, (x.shape[1], HIDDEN)), "e": np.zeros(HIDDEN),
         "V": r.normal(0, 0.3, (HIDDEN, GATE)), "U": r.normal(0, 0.3, (HIDDEN, GATE)),
         "a": r.normal(0, 0.3, GATE), "c": r.normal(0, 0.3, HIDDEN), "b": np.array(0.0)}
    adam = Adam(rate)
    for _ in range(steps):
        h, a, logit, z, v, u = _forward(w, x, bag, n)
        g = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y) / n
        gz = g[:, None] * w["c"]
        da = (gz[bag] * h).sum(1)
        draw = a * (da - np.bincount(bag, a * da, n)[bag])
        gate = draw[:, None] * w["a"]
        gv, gu = gate * u * (1 - v ** 2), gate * v * u * (1 - u)
        gh = (a[:, None] * gz[bag] + gv @ w["V"].T + gu @ w["U"].T) * (1 - h ** 2)
        grads = {"E": x.T @ gh, "e": gh.sum(0), "V": h.T @ gv, "U": h.T @ gu,
                 "a": (v * u).T @ draw, "c": z.T @ g, "b": g.sum()}
        adam.step(w, {k: d + 1e-5 * w[k] for k, d in grads.items()})
    return AttentionModel(mean, scale, w)


def score(docs: DataFrame, model: AttentionModel, text_col: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1), ``predicted`` and ``passage``, the number of the passage
    with the greatest attention."""
    made = ["score", "predicted", "passage"]
    keep = [c for c in docs.columns if c not in made]
    schema = T.StructType([*docs.select(*[f"`{c}`" for c in keep]).schema,
                           T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()),
                           T.StructField("passage", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [one.score(passages(t or "")) for t in part.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep],
                     pa.array([s for s, _ in found], pa.float64()),
                     pa.array([int(s >= KEEP_AT) for s, _ in found], pa.int32()),
                     pa.array([int(a.argmax()) for _, a in found], pa.int32())],
                    names=[*keep, *made])

    return docs.mapInArrow(run, schema)
