"""The bounded labelled sample that the two document classifiers learn from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import text_of

# Labelled documents that a classifier learns from, at most, and the longest of them.
SAMPLE_DOCS = 4_000
SAMPLE_CHARS = 50_000


def held_out(id_col: str = "doc_id") -> Column:
    """True for rows kept from learning; a null id counts as the empty text."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str,
                    limit: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS
                    ) -> list[tuple[str, int]]:
    """(text, label) of at most ``limit`` labelled rows that are not held out, in the order
    of their ids' md5: a fixed draw. Rows with a null id or label teach nothing; of
    several labels of an id the greatest holds."""
    order = F.md5(F.col("doc_id").cast("string"))
    chosen = (labels.filter(~held_out() & F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max(label_col).alias("_label"))
              .orderBy(order, "doc_id").limit(limit))
    texts = docs.select("doc_id", text_of().alias("_text")).filter(F.length("_text") <= max_chars)
    # at most ``limit`` labels: a bounded side
    joined = texts.join(F.broadcast(chosen), "doc_id").orderBy(order, F.md5("_text")).limit(limit)
    return [(r["_text"], int(r["_label"])) for r in joined.select("_text", "_label").collect()]


class Adam:
    """Gradient steps over a dict of arrays, with an optional soft threshold per name."""

    def __init__(self, rate: float) -> None:
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, weights: dict, grads: dict, shrink: dict | None = None) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m.get(k, 0.0) + 0.1 * g
            self.v[k] = 0.999 * self.v.get(k, 0.0) + 0.001 * g * g
            scale = self.rate / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)
            weights[k] = weights[k] - scale * self.m[k] / (1 - 0.9 ** self.t)
            if shrink and k in shrink:
                cut = self.rate * shrink[k]
                weights[k] = np.sign(weights[k]) * np.maximum(np.abs(weights[k]) - cut, 0)
