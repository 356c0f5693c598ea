"""Gradient-boosted trees grown for many training windows at once (O-48, O-49, O-56, O-57c, O-91).

Rows are quantised once: a feature value becomes the number of its bin between shared edges, a byte.
All models (each fold of a backtest, each family) read this one table; a model trains on the rows up to its
last month. Trees grow from sums of gradients by (node, feature, bin), in one of two ways with the
same sums, splits and row samples:

* While the quantised table is at most SHARED_BYTES, it is broadcast, and every model is grown in a task of
  its own, all models side by side.
* Beyond that the models grow together over blocks of rows, a level at a time: tasks add the gradients
  of their rows by (model, node, feature, bin). Sums of a few MB meet on the driver; more of them meet by
  model, and one task a model picks its splits. Blocks carry the margins of the models that train on them, and
  stay persisted on the executors from pass to pass. The driver holds sums, trees and splits, never rows.

Depth-wise growth splits every node down to ``max_depth``. Leaf-wise growth splits the leaf of greatest
gain until ``max_leaves``: each pass evaluates the leaves that this order may reach, and the order
is settled once no leaf in it is unknown.

Defined results: a null value takes the bin of the window's median; rows without a label or a month do not
train; a window of one label, or without rows, gives trees of one leaf; equal gains go to the first feature
and bin; rows alike in all values are sampled alike.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LABEL
from ..session import ensure_checkpoint_dir

BINS, BLOCK_ROWS, MODELS_A_BLOCK, TREES_A_CHECKPOINT = 64, 1 << 20, 10, 50
MIN_ROWS = 1 << 14  # of a block, to deal rows to all cores
BLOCKS_A_TASK = 4  # at most, read one after the other
SHARED_BYTES = 64 << 20
SUMS_BYTES = 32 << 20  # sums of a pass that may meet on the driver
DERIVED_ROWS = 100_000  # from here on a larger child's sums are its parent's without the smaller child's
JOINT_CELLS = 1 << 15  # of the bins of several features that are counted as one
JOINT_ROWS = 1 << 12  # of a node, from here on
CHUNK_ROWS = 1 << 13  # of a table that go through trees together
WINDOW_ROWS = 1 << 16  # of a table that many models score, each a part of them
PLACES = 64  # leaves of a tree whose set is one word
_WORD = np.uint64(0x03F79D71B4CB0A89)  # times a power of two: another place in the upper six bits for each
_PLACE = (((np.uint64(1) << np.arange(PLACES, dtype=np.uint64)) * _WORD) >> np.uint64(58)).astype(np.intp)


@dataclass(frozen=True)
class Growth:
    n_estimators: int = 300
    learning_rate: float = 0.05
    max_depth: int | None = None
    max_leaves: int | None = None
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    reg_lambda: float = 0.0
    min_child_weight: float = 1e-3
    min_rows: int = 1
    random_state: int = 42


# The parameter sets of the two boosted families. Their libraries' own defaults where none is
# set: a child's least hessian and rows, and no row sampling leaf-wise, which needs a frequency.
GROWTH = {
    "xgboost": Growth(max_depth=6, subsample=0.9, colsample_bytree=0.9, reg_lambda=1.0, min_child_weight=1.0),
    "lightgbm": Growth(max_leaves=31, colsample_bytree=0.9, min_rows=20),
}


def growth(family: str, params: dict | None = None) -> Growth:
    names = {"num_leaves": "max_leaves"}
    known = Growth.__dataclass_fields__
    return replace(GROWTH[family], **{names.get(k, k): v for k, v in (params or {}).items()
                                      if names.get(k, k) in known})


@dataclass
class Tree:
    """Nodes in arrays: feature (-1 at a leaf), threshold bin (left if at most), children, the margin that
    a row of the node gets on average, and its sum of hessians."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def __getstate__(self) -> dict:
        return {f: self.__dict__[f] for f in self.__dataclass_fields__}

    def parted(self, columns: Sequence[np.ndarray], size: int):
        return _parted(self.feature, self.threshold, self.left, self.right, columns, size)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        return self.margins(_columns_of(bins), len(bins))

    def words(self) -> _Words | None:
        """Made once; None if the tree has more than ``PLACES`` leaves."""
        if "_words" not in self.__dict__:
            self._words = _Words.of(self.feature, self.threshold, self.left, self.right)
            self._values = None if self._words is None else self._words.by_place(self.value)
        return self._words

    def margins(self, columns: Sequence[np.ndarray], size: int) -> np.ndarray:
        if (words := self.words()) is not None:
            return self._values.take(words.places(columns, size))
        made = np.empty(size)
        for node, rows in self.parted(columns, size):
            if self.feature[node] < 0:
                made[rows] = self.value[node]
        return made

    def steps(self) -> list[tuple[int, np.ndarray]]:
        """(feature, change of the mean margin by the place of a row's leaf), made once: the first, second, ... step on
        a feature on the way to the leaf."""
        if "_steps" not in self.__dict__:
            words, ways = self.words(), {0: []}
            made: dict[tuple[int, int], np.ndarray] = {}
            for i in range(len(self.value)):
                if self.feature[i] >= 0:
                    for child in (self.left[i], self.right[i]):
                        ways[child] = [*ways[i], (int(self.feature[i]), self.value[child] - self.value[i])]
            for place, leaf in zip(_PLACE, words.leaves):
                met: dict[int, int] = {}
                for f, change in ways[leaf]:
                    made.setdefault((f, met.get(f, 0)), np.zeros(PLACES))[place] = change
                    met[f] = met.get(f, 0) + 1
            self._steps = [(f, made[f, nth]) for f, nth in sorted(made)]
        return self._steps


@dataclass
class _Words:
    """A tree's leaves as bits: for each feature that it splits on, the leaves that a row of a bin may reach. The sets
    of all features have one leaf in common."""
    leaves: np.ndarray
    features: list[int]
    table: np.ndarray  # features x bins

    @staticmethod
    def of(feature, threshold, left, right) -> _Words | None:
        leaves, inner = np.flatnonzero(feature < 0), np.flatnonzero(feature >= 0)
        if len(leaves) > PLACES:
            return None
        below = [0] * len(feature)
        for i, leaf in enumerate(leaves.tolist()):
            below[leaf] = 1 << i
        for i in inner[::-1].tolist():  # children follow their node
            below[i] = below[left[i]] | below[right[i]]
        if not len(inner):
            return _Words(leaves, [], np.empty((0, BINS + 1), np.uint64))
        sets, order = np.array(below, np.uint64), inner[np.argsort(feature[inner], kind="stable")]
        features, starts = np.unique(feature[order], return_index=True)
        low = np.arange(BINS + 1) <= threshold[order][:, None]
        kept = np.where(low, ~sets[right[order]][:, None], ~sets[left[order]][:, None])
        return _Words(leaves, features.tolist(), np.bitwise_and.reduceat(kept, starts, axis=0) & sets[0])

    def by_place(self, values: np.ndarray, rest=0.0) -> np.ndarray:
        """Values of nodes by the place of a leaf."""
        made = np.full(PLACES, rest, values.dtype)
        made[_PLACE[:len(self.leaves)]] = values[self.leaves]
        return made

    def places(self, columns: Sequence[np.ndarray], size: int) -> np.ndarray:
        """The place of each row's leaf."""
        if not self.features:
            return np.full(size, _PLACE[0])
        held = self.table[0].take(columns[self.features[0]])
        for f, own in zip(self.features[1:], self.table[1:]):
            held &= own.take(columns[f])
        return _place(held)

    def filled(self, medians: np.ndarray) -> _Words:
        """Null bins reach what their medians do."""
        table = self.table.copy()
        table[:, 0] = table[np.arange(len(table)), np.asarray(medians, int)[self.features]]
        return replace(self, table=table)

    def joint(self, groups: list[list[int]], sizes: Sequence[int]) -> list[tuple[int, np.ndarray]]:
        """(group, the leaves that a combination of its bins may reach) of the groups that the tree splits on."""
        by, made = dict(zip(self.features, self.table)), []
        for i, own in enumerate(groups):
            if set(own) & set(self.features):
                whole = np.full(1, ~np.uint64(0))
                for f in own:
                    one = by[f][:sizes[f]] if f in by else np.full(sizes[f], ~np.uint64(0))
                    whole = (whole[:, None] & one).ravel()
                made.append((i, whole))
        return made


def _place(held: np.ndarray) -> np.ndarray:
    """Of words with one bit."""
    return ((held * _WORD) >> np.uint64(58)).view(np.int64)


def _parted(feature, threshold, left, right, columns: Sequence[np.ndarray], size: int):
    """(node, an index of its rows) from the root down; a node's children follow it."""
    held = [(0, slice(0, size))]
    while held:
        node, rows = held.pop()
        yield node, rows
        if (f := feature[node]) >= 0:
            low = columns[f][rows] <= threshold[node]
            for child, side in ((right[node], False), (left[node], True)):
                taken = np.flatnonzero(low == side)
                held.append((child, taken if node == 0 else rows[taken]))


def _columns_of(bins: np.ndarray) -> list[np.ndarray]:
    return [np.ascontiguousarray(bins[:, f]) for f in range(bins.shape[1])]


def _chunks(bins: np.ndarray) -> Iterator[tuple[slice, list[np.ndarray], int]]:
    """(rows, their columns, their number) of a few rows at a time, which stay in the cache."""
    for a in range(0, len(bins), CHUNK_ROWS):
        part = bins[a:a + CHUNK_ROWS]
        yield slice(a, a + len(part)), [part[:, f].astype(np.intp) for f in range(bins.shape[1])], len(part)


@dataclass
class Booster:
    """A model: trains on months up to ``last``; ``base`` is its margin before any tree."""
    name: str
    last: int
    growth: Growth
    edges: list[np.ndarray] = field(default_factory=list)
    medians: np.ndarray | None = None
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def sizes(self) -> list[int]:
        """The number of bins of each feature, with that of null."""
        return [len(e) + 2 for e in self.edges]

    def bins(self, raw: np.ndarray) -> np.ndarray:
        return filled(quantised(raw, self.edges), self.medians)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for own, columns, size in _chunks(bins):
            for tree in self.trees:
                total[own] += tree.margins(columns, size)
        return total

    def occluded(self, bins: np.ndarray, put: np.ndarray) -> list[np.ndarray]:
        """The margin of the rows, and that with each feature in turn in its bin of ``put``."""
        made = np.full((1 + len(put), len(bins)), self.base)
        for own, columns, size in _chunks(bins):
            for tree in self.trees:
                words = tree.words()
                if words is None:
                    made[0, own] += tree.margins(columns, size)
                    for f, x in enumerate(put):
                        made[1 + f, own] += tree.margins([*columns[:f], np.full(size, x, np.intp), *columns[f + 1:]], size)
                    continue
                sets = [t.take(columns[f]) for f, t in zip(words.features, words.table)]
                after = [np.full(size, ~np.uint64(0))]  # what the features from here on have in common
                for x in reversed(sets):
                    after.append(after[-1] & x)
                whole = tree._values.take(_place(after[-1])) if sets else np.full(size, tree.value[words.leaves[0]])
                made[0, own] += whole
                for f in set(range(len(put))) - set(words.features):
                    made[1 + f, own] += whole
                before = after[0]
                for i, f in enumerate(words.features):
                    rest = before & after[len(sets) - 1 - i]
                    made[1 + f, own] += tree._values.take(_place(rest & words.table[i, put[f]]))
                    before = before & sets[i]
        return list(made)

    def contributions(self, bins: np.ndarray) -> tuple[float, np.ndarray]:
        """(base, rows x features): the base and a row's contributions add up to its margin. Walking down a
        tree, each step's change of the mean margin goes to the feature that it splits on."""
        made = np.zeros((len(self.edges), len(bins)))
        base = self.base
        for t in self.trees:
            base += t.value[0]
        if all(t.words() is not None for t in self.trees):
            for own, columns, size in _chunks(bins):
                for t in self.trees:
                    places = t.words().places(columns, size)
                    for f, change in t.steps():
                        made[f, own] += change.take(places)
            return base, np.ascontiguousarray(made.T)
        columns = _columns_of(bins)
        for t in self.trees:
            step = {}  # of a node: the feature that its parent splits on, and the change of the mean margin
            for node, rows in t.parted(columns, len(bins)):
                if node in step:
                    f, change = step[node]
                    made[f][rows] += change  # a cell once
                if t.feature[node] >= 0:
                    for child in (t.left[node], t.right[node]):
                        step[child] = t.feature[node], t.value[child] - t.value[node]
        return base, np.ascontiguousarray(made.T)

    def gains(self) -> np.ndarray:
        """Each feature's share of the gain of all splits, every tree counted alike; zeros without a split."""
        made, g = np.zeros(len(self.edges)), self.growth
        for t in self.trees:
            own, sums = np.zeros(len(self.edges)), np.zeros(len(t.value))
            for i in range(len(t.value) - 1, -1, -1):
                h = t.cover + g.reg_lambda
                if t.feature[i] < 0:
                    sums[i] = -t.value[i] * h[i] / g.learning_rate
                    continue
                a, b = t.left[i], t.right[i]
                sums[i] = sums[a] + sums[b]
                own[t.feature[i]] += sums[a] ** 2 / h[a] + sums[b] ** 2 / h[b] - sums[i] ** 2 / h[i]
            made += own / own.sum() if own.sum() > 0 else 0.0
        return made / made.sum() if made.sum() > 0 else made


def quantised(raw: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins of a matrix of doubles: 0 for null, then 1 + the number of edges below the value."""
    made = np.empty(raw.shape, np.uint8)
    for f, cuts in enumerate(edges):
        column = raw[:, f]
        made[:, f] = np.where(np.isnan(column), 0, 1 + np.searchsorted(cuts, column, side="left"))
    return made


def filled(bins: np.ndarray, medians: np.ndarray | None) -> np.ndarray:
    if medians is None or bins.all():
        return bins
    return np.where(bins == 0, medians.astype(np.uint8), bins)


def bin_edges(df: DataFrame, cols: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """At most bins - 2 ascending edges a feature, from one pass of quantile sketches."""
    shares = [i / (bins - 1) for i in range(1, bins - 1)]
    row = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), shares, 20_000).alias(c)
                   for c in cols]).first()
    return [np.array(sorted(set(row[c] or []))) for c in cols]


# ---- growing one tree, on the driver ---------------------------------------------


class _Growing:
    """A tree in growth: nodes with their sums, and the best split of those that were evaluated."""

    def __init__(self, g: Growth, columns: np.ndarray) -> None:
        self.g, self.columns = g, columns
        self.depth, self.sums, self.split, self.children = [0], [None], [None], [None]
        self.chosen: set[int] = set()

    def _descend(self, node: int) -> tuple[int, int]:
        if self.children[node] is None:
            left, total = self.split[node][2], self.sums[node]
            for sums in (left, total - left):
                self.depth.append(self.depth[node] + 1)
                self.sums.append(sums)
                self.split.append(None)
                self.children.append(None)
            self.children[node] = (len(self.depth) - 2, len(self.depth) - 1)
        return self.children[node]

    def unknown(self) -> list[int]:
        """The nodes whose best split the growth needs next; none once the tree is settled."""
        if self.split[0] is None:
            return [0]
        wanted, self.chosen = [], set()
        deepest = self.g.max_depth if self.g.max_depth is not None else 1 << 30
        most = self.g.max_leaves if self.g.max_leaves is not None else 1 << 30
        open_nodes, leaves = [], 1

        def offer(node: int) -> None:
            if self.depth[node] >= deepest:
                return
            if self.split[node] is None:
                wanted.append(node)
            elif self.split[node]:
                heapq.heappush(open_nodes, (-self.split[node][3], node))

        offer(0)
        while open_nodes and leaves < most:
            node = heapq.heappop(open_nodes)[1]
            self.chosen.add(node)
            leaves += 1
            for child in self._descend(node):
                if leaves < most:
                    offer(child)
        return wanted

    def arrays(self, only: set[int] | None = None):
        """feature, threshold, left, right of the nodes split so far, or of those chosen."""
        n = len(self.depth)
        feature, threshold = np.full(n, -1), np.zeros(n, np.int64)
        left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for node in range(n):
            if self.children[node] and (only is None or node in only):
                feature[node], threshold[node] = self.split[node][0], self.split[node][1]
                left[node], right[node] = self.children[node]
        return feature, threshold, left, right

    def tree(self) -> Tree:
        """The settled tree: the nodes that the chosen splits reach, children after their node."""
        order = self.order = [0]
        for node in order:
            if node in self.chosen:
                order.extend(self.children[node])
        place = {node: i for i, node in enumerate(order)}
        feature, threshold, left, right = (x[order] for x in self.arrays(self.chosen))
        for i, node in enumerate(order):
            if node in self.chosen:
                left[i], right[i] = (place[c] for c in self.children[node])
        value, cover = np.zeros(len(order)), np.zeros(len(order))
        for i in range(len(order) - 1, -1, -1):
            g, h, _ = self.sums[order[i]]
            cover[i] = h
            if feature[i] < 0:
                value[i] = -self.g.learning_rate * g / (h + self.g.reg_lambda) if h > 0 else 0.0
            else:
                a, b = left[i], right[i]
                whole = cover[a] + cover[b]
                value[i] = (cover[a] * value[a] + cover[b] * value[b]) / whole if whole > 0 else 0.0
        return Tree(feature.astype(np.int16), threshold.astype(np.int16), left.astype(np.int32),
                    right.astype(np.int32), value, cover)


def best_splits(sums: np.ndarray, g: Growth, columns: np.ndarray) -> np.ndarray:
    """``sums``: nodes x features x bins x (gradient, hessian, rows). -> nodes x (feature, bin, left sums,
    gain, whole sums); feature -1 where no split gains."""
    whole = sums[:, 0].sum(axis=1)
    low = np.cumsum(sums, axis=2)[:, :, :-1]
    high = whole[:, None, None] - low

    def score(x):
        h = x[..., 1] + g.reg_lambda
        return np.divide(x[..., 0] ** 2, h, out=np.zeros_like(h), where=h > 0)

    gain = score(low) + score(high) - score(whole)[:, None, None]
    fits = ((low[..., 1] >= g.min_child_weight) & (high[..., 1] >= g.min_child_weight)
            & (low[..., 2] >= max(1, g.min_rows)) & (high[..., 2] >= max(1, g.min_rows)))
    fits &= np.isin(np.arange(sums.shape[1]), columns)[None, :, None]
    gain = np.where(fits, gain, -np.inf).reshape(len(sums), -1)
    best = gain.argmax(axis=1)
    at = np.arange(len(sums))
    found = gain[at, best] > 1e-9
    f, b = np.divmod(best, low.shape[2])
    return np.column_stack([np.where(found, f, -1), b, low[at, f, b], np.where(found, gain[at, best], 0), whole])


# ---- passes over the blocks ------------------------------------------------------


def _blocks(rows: DataFrame, edges: list[np.ndarray], last: list[int], n_rows: int) -> DataFrame:
    """(month, label, key, x) rows -> part, n, data, margins: the rows of a block by month, with the
    margins (still zero) of one part of the models on the rows that each trains on."""
    parts = max(1, -(-len(last) // MODELS_A_BLOCK))
    most = max(1, BLOCK_ROWS // parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0

        def block() -> pa.RecordBatch:
            month, label, key, raw = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(month, kind="stable")
            month, label, key, bins = month[order], label[order], key[order], quantised(raw[order], edges)
            data = (key.astype("<i8").tobytes() + month.astype("<i4").tobytes() + label.astype("u1").tobytes()
                    + bins.T.tobytes())
            size = [sum(int(np.searchsorted(month, m, side="right")) for m in last[p::parts]) for p in range(parts)]
            return pa.RecordBatch.from_arrays(
                [pa.array(range(parts), pa.int32()), pa.array([len(month)] * parts, pa.int32()),
                 pa.array([data] * parts, pa.binary()), pa.array([bytes(8 * s) for s in size], pa.binary())],
                names=["part", "n", "data", "margins"])

        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                raw = part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(edges))
                held.append((*(part.column(i).to_numpy() for i in range(3)), raw))
                n += part.num_rows
                if n >= most:
                    yield block()
                    held, n = [], 0
        if held:
            yield block()

    slots = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-n_rows // most))
    if n_rows > slots * MIN_ROWS:  # the cores end a pass together; a task costs as much as the sums of many rows
        tasks = -(-tasks // (slots * BLOCKS_A_TASK)) * slots
    return (rows.repartition(tasks)
            .mapInArrow(run, "part int, n int, data binary, margins binary"))


class _Rows:
    """Quantised rows by month."""

    def __init__(self, n: int, data: bytes) -> None:
        self.key = np.frombuffer(data, "<i8", n)
        self.month = np.frombuffer(data, "<i4", n, 8 * n)
        self.label = np.frombuffer(data, "u1", n, 12 * n).astype(float)
        self.bins = np.frombuffer(data, "u1", -1, 13 * n).reshape(-1, n).T if n else np.empty((0, 0), np.uint8)

    def upto(self, month: int) -> int:
        return int(np.searchsorted(self.month, month, side="right"))

    def counts(self, size: int) -> np.ndarray:
        """Rows by feature and bin, label sum and rows of a window."""
        made = [np.bincount(self.bins[:size, f], minlength=BINS + 1) for f in range(self.bins.shape[1])]
        return np.concatenate([np.array(made, float).ravel(), [self.label[:size].sum(), size]])


def _drawn(key: np.ndarray, g: Growth, t: int) -> np.ndarray:
    """Which rows a tree's sample holds: a hash of the row, the seed and the tree against the share."""
    salt = np.random.default_rng([g.random_state, t]).integers(0, 1 << 63, dtype=np.uint64)
    x = (key.astype(np.uint64) ^ salt) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(11)) < np.uint64(int(g.subsample * (1 << 53)))


def _columns(g: Growth, t: int, width: int) -> np.ndarray:
    rng = np.random.default_rng([g.random_state, t, 1])
    return np.sort(rng.permutation(width)[:max(1, int(g.colsample_bytree * width))])


def _start(model: Booster, counts: np.ndarray) -> None:
    """The window's median bins and its margin before any tree."""
    by, (positive, n) = counts[:-2].reshape(-1, BINS + 1)[:, 1:], counts[-2:]
    model.medians = np.minimum(BINS, 1 + (np.cumsum(by, axis=1) < by.sum(axis=1, keepdims=True) / 2).sum(axis=1))
    share = min(max(positive / n, 1e-6), 1 - 1e-6) if n else 0.5
    model.base = float(np.log(share / (1 - share)))


def _answer(growing: _Growing, nodes: list[int], best: np.ndarray | None) -> None:
    """Enters the best splits of the nodes; None: no rows."""
    if best is None:
        best = np.tile([-1.0] + [0.0] * 8, (len(nodes), 1))
    for node, (f, b, *rest) in zip(nodes, best, strict=True):
        growing.sums[node] = np.array(rest[4:])
        growing.split[node] = (int(f), int(b), np.array(rest[:3]), rest[3]) if f >= 0 else ()


def _node_sums(columns: list[np.ndarray], wanted: set[int], own: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Sums of (gradient, hessian, rows) of the rows ``own`` by feature and bin; zeros for features not wanted.
    ``g`` and ``h``: of these rows."""
    made = np.zeros((len(columns), BINS + 1, 3))
    for f in wanted:
        at = columns[f][own].astype(np.intp)
        made[f, :, 0] = np.bincount(at, g, BINS + 1)
        made[f, :, 1] = np.bincount(at, h, BINS + 1)
        made[f, :, 2] = np.bincount(at, minlength=BINS + 1)
    return made


def _joined(sizes: Sequence[int]) -> list[list[int]]:
    """Features in groups whose bins have at most ``JOINT_CELLS`` combinations: the large ones first."""
    groups: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
        for own in groups:
            if np.prod([sizes[x] for x in own]) * sizes[f] <= JOINT_CELLS:
                own.append(f)
                break
        else:
            groups.append([f])
    return groups


def _codes(columns: Sequence[np.ndarray], sizes: Sequence[int]) -> list[tuple[list[int], list[int], np.ndarray]]:
    """(features, their bins, each row's combination of bins) of each group of ``_joined``."""
    made = []
    for own in _joined(sizes):
        code = columns[own[0]].astype(np.uint16)
        for f in own[1:]:
            code = code * np.uint16(sizes[f]) + columns[f]
        made.append((own, [sizes[f] for f in own], code))
    return made


def _joint_sums(codes, width: int, own: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The sums of ``_node_sums`` for all features, from sums by combinations of bins."""
    made = np.zeros((width, BINS + 1, 3))
    for features, sizes, code in codes:
        at, cells = code.take(own).astype(np.intp), int(np.prod(sizes))
        for i, weights in enumerate((g, h, None)):
            by = np.bincount(at, weights, cells).reshape(sizes)
            for axis, f in enumerate(features):
                made[f, :sizes[axis], i] = by.sum(axis=tuple(x for x in range(len(sizes)) if x != axis))
    return made


def grown(model: Booster, rows: _Rows) -> Booster:
    """One model from all rows of its window. In a window of ``MIN_ROWS`` a large node's features are counted in
    groups, and the larger of two children is its parent without the other."""
    size, g = rows.upto(model.last), model.growth
    _start(model, rows.counts(size))
    bins, label = filled(rows.bins[:size], model.medians), rows.label[:size]
    columns = _columns_of(bins)
    large = size >= MIN_ROWS
    codes = _codes(columns, model.sizes()) if large else []
    total = np.full(size, model.base)
    for t in range(g.n_estimators):
        p = 1 / (1 + np.exp(-total))
        gradient, hessian = p - label, p * (1 - p)
        drawn = _drawn(rows.key[:size], g, t) if g.subsample < 1 else None
        growing = _Growing(g, _columns(g, t, len(columns)))
        wanted = {0, *growing.columns.tolist()}  # the first feature's bins give a node's whole sums
        at = {0: np.arange(size, dtype=np.int32)}  # the rows of each node
        known: dict[int, np.ndarray] = {}  # sums of nodes, in a large window

        def spread() -> None:
            for parent, children in enumerate(growing.children):
                if children and children[0] not in at:
                    f, b = growing.split[parent][:2]
                    low = columns[f].take(at[parent]) <= b
                    at[children[0]] = at[parent].take(np.flatnonzero(low))
                    at[children[1]] = at[parent].take(np.flatnonzero(~low))

        def sums(node: int) -> np.ndarray:
            own = at[node] if drawn is None else at[node].take(np.flatnonzero(drawn.take(at[node])))
            if large and len(own) >= JOINT_ROWS:
                return _joint_sums(codes, len(columns), own, gradient.take(own), hessian.take(own))
            return _node_sums(columns, wanted, own, gradient.take(own), hessian.take(own))

        while nodes := growing.unknown():
            spread()
            direct = {n: sums(n) for n in (_smaller(growing, nodes, known, 0) if large else nodes)}
            whole = _with_larger(growing, nodes, direct, known) if large else np.stack([direct[n] for n in nodes])
            _answer(growing, nodes, best_splits(whole, g, growing.columns))
        spread()
        tree = growing.tree()
        model.trees.append(tree)
        for node, feature, value in zip(growing.order, tree.feature, tree.value, strict=True):
            if feature < 0:
                total[at[node]] += value
    return model


def _cut_rows(models: list[Booster]):
    """A block as a state row: part, n, the rows that each model of the part trains on, data without what no
    model needs (keys if rows are sampled, combinations of bins, labels), margins."""
    parts, sampled = -(-len(models) // MODELS_A_BLOCK), any(m.growth.subsample < 1 for m in models)
    sizes_of = models[0].sizes()

    def run(row) -> tuple:
        part, n, data, margins = row
        rows = _Rows(n, data)
        sizes = [rows.upto(models[k].last) for k in range(part, len(models), parts)]
        codes = b"".join(c.astype("<u2").tobytes() for _, _, c in _codes(_columns_of(rows.bins), sizes_of))
        return (part, n, sizes, bytes(data[:8 * n] if sampled else b"") + codes + bytes(data[12 * n:13 * n]),
                bytes(margins))

    return run


class _Cut:
    """One state row: its rows and, for each model of its part, the rows and margins that it trains on."""

    def __init__(self, part: int, n: int, sizes: list[int], data: bytes, margins: bytes, models: list[Booster]) -> None:
        keys = 8 * n if any(m.growth.subsample < 1 for m in models) else 0
        self.sizes = models[0].sizes()
        self.groups = _joined(self.sizes)
        self.key = np.frombuffer(data, "<i8", n) if keys else None
        self.codes = np.frombuffer(data, "<u2", n * len(self.groups), keys).reshape(-1, n)
        self.label = np.frombuffer(data, "u1", n, keys + 2 * n * len(self.groups))
        margin, at, self.own = np.frombuffer(margins, "<f8"), 0, []
        for k, size in zip(range(part, len(models), -(-len(models) // MODELS_A_BLOCK)), sizes, strict=True):
            self.own.append((k, size, margin[at:at + size]))
            at += size

    def _by_group(self) -> list[tuple[list[int], list[int], np.ndarray]]:
        return [(own, [self.sizes[f] for f in own], code) for own, code in zip(self.groups, self.codes, strict=True)]

    def columns(self, model: Booster, own) -> list[np.ndarray]:
        """The bins of the rows ``own``, a null's that of the median."""
        made: list = [None] * len(self.sizes)
        for features, sizes, code in self._by_group():
            rest = code[own]
            for f, size in zip(reversed(features), reversed(sizes)):
                rest, at = np.divmod(rest, np.uint16(size))
                made[f] = np.where(at == 0, np.uint16(model.medians[f]), at)
        return made

    def counts(self, size: int) -> np.ndarray:
        """Rows by feature and bin, label sum and rows of a window."""
        made = np.zeros((len(self.sizes), BINS + 1))
        for features, sizes, code in self._by_group():
            by = np.bincount(code[:size].astype(np.intp), minlength=int(np.prod(sizes))).reshape(sizes)
            for axis, f in enumerate(features):
                made[f, :sizes[axis]] = by.sum(axis=tuple(x for x in range(len(sizes)) if x != axis))
        return np.concatenate([made.ravel(), [self.label[:size].sum(dtype=float), size]])

    def sums(self, model: Booster, own: np.ndarray, wanted: set[int], g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """``_node_sums`` of the rows ``own``."""
        if len(own) < JOINT_ROWS:
            return _node_sums(self.columns(model, own), wanted, slice(None), g, h)
        made = _joint_sums(self._by_group(), len(self.sizes), own, g, h)
        for f, median in enumerate(model.medians):
            if made[f, 0].any():
                made[f, int(median)] += made[f, 0]
                made[f, 0] = 0.0
        return made

    def by_leaf(self, words: _Words, model: Booster, values: np.ndarray, size: int) -> np.ndarray:
        """The value of each row's leaf, of ``values`` by place."""
        tables = words.filled(model.medians).joint(self.groups, self.sizes)
        if not tables:
            return np.full(size, values[_PLACE[0]])
        made = np.empty(size, values.dtype)
        for a in range(0, size, CHUNK_ROWS):
            b = min(a + CHUNK_ROWS, size)
            held = tables[0][1].take(self.codes[tables[0][0], a:b])
            for i, table in tables[1:]:
                held &= table.take(self.codes[i, a:b])
            made[a:b] = values.take(_place(held))
        return made


def _summed(state: RDD, models: list[Booster], sums) -> RDD:
    """(model, ``sums(cut, k, size, margins)`` added over the blocks of a task)."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        totals: dict[int, np.ndarray] = {}
        for row in rows:
            cut = _Cut(*row, models)
            for k, size, margin in cut.own:
                made = sums(cut, k, size, margin)
                if made is not None:
                    totals[k] = totals[k] + made if k in totals else made
        yield from totals.items()

    return state.mapPartitions(run)


def _met(made: RDD, tasks: int) -> dict[int, np.ndarray]:
    """The sums of ``_summed`` by model: here, if they are few, or first by model in ``tasks`` tasks."""
    totals: dict[int, np.ndarray] = {}
    for k, x in reversed((made.reduceByKey(lambda a, b: a + b, tasks) if tasks else made).collect()):
        totals[k] = totals[k] + x if k in totals else x
    return totals


def _store(spark: SparkSession, state: RDD) -> tuple[RDD, str]:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/boosting-{uuid.uuid4().hex}"
    state.saveAsPickleFile(path)
    read = spark.sparkContext.pickleFile(path).coalesce(state.getNumPartitions())  # large files come in pieces
    return read.persist(StorageLevel.MEMORY_AND_DISK), path


def _dropped(state: RDD, path: str) -> None:
    """Removes an intermediate table of this run once the next one is whole."""
    place = state.ctx._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(state.ctx._jsc.hadoopConfiguration()).delete(place, True)


def grow(df: DataFrame, models: list[Booster], cols: Sequence[str], month: Column, label: str = LABEL,
         shared_bytes: int = SHARED_BYTES) -> list[Booster]:
    """Grows all ``models`` on the rows of ``df`` up to their last ``month`` (an integer column). A
    quantised table beyond ``shared_bytes`` is not broadcast."""
    usable = df.filter(F.col(label).isNotNull() & month.isNotNull() & (month <= max(m.last for m in models)))
    edges = bin_edges(usable, cols)
    value = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])
    rows = usable.select(month.cast("int").alias("month"), F.col(label).cast("int").alias("label"), value.alias("x"))
    rows = rows.select("month", "label", F.xxhash64("month", "label", "x").alias("key"), "x")
    n = usable.count()
    models = [replace(m, edges=edges, trees=[]) for m in models]
    if n * (13 + len(cols)) <= shared_bytes:
        return _grown_side_by_side(rows, models, n)
    return _grown_together(rows, models, n)


def _grown_side_by_side(rows: DataFrame, models: list[Booster], n: int) -> list[Booster]:
    spark = rows.sparkSession
    blocks = _blocks(rows, models[0].edges, [], n).select("n", "data").collect()  # of a checked size
    parts = [_Rows(r["n"], bytes(r["data"])) for r in blocks]
    width = len(models[0].edges)
    month, label, key = (np.concatenate([getattr(p, c) for p in parts] or [np.empty(0)]) for c in ("month", "label", "key"))
    bins = np.concatenate([p.bins for p in parts] or [np.empty((0, width), np.uint8)])
    order = np.lexsort((key, month))
    data = (key[order].astype("<i8").tobytes() + month[order].astype("<i4").tobytes()
            + label[order].astype("u1").tobytes() + bins[order].T.tobytes())
    shared = spark.sparkContext.broadcast((len(order), data, models))

    def run(k: int) -> tuple[int, Booster]:
        size, whole, own = shared.value
        return k, grown(replace(own[k], trees=[]), _Rows(size, whole))

    # a task a model; windows that end late are the longest and go first
    work = sorted(range(len(models)), key=lambda k: -models[k].last)
    found = dict(spark.sparkContext.parallelize(work, max(1, len(work))).map(run).collect())
    shared.unpersist()
    return [found[k] for k in range(len(models))]


def _grown_together(rows: DataFrame, models: list[Booster], n: int) -> list[Booster]:
    blocks = _blocks(rows, models[0].edges, [m.last for m in models], n).rdd
    state, path = _store(rows.sparkSession, blocks.map(_cut_rows([replace(m, trees=[]) for m in models])))
    width, tasks = len(models[0].edges), -(-len(models) // MODELS_A_BLOCK)
    found = _met(_summed(state, models, lambda cut, k, size, margin: cut.counts(size)), tasks)
    for k, x in found.items():
        _start(models[k], x)
    light = [replace(m, trees=[]) for m in models]  # what tasks need of a model
    trees = max(m.growth.n_estimators for m in models)
    before = None  # the state of the last tree, which the first pass over the next one reads
    for t in range(trees):
        growing = {k: _Growing(m.growth, _columns(m.growth, t, width)) for k, m in enumerate(models)
                   if t < m.growth.n_estimators}
        known: dict[int, dict[int, np.ndarray]] = {k: {} for k in growing}  # sums of nodes, where they met here
        while asked := {k: nodes for k, g in growing.items() if (nodes := g.unknown())}:
            number = sum(len(nodes) for nodes in asked.values()) * width * (BINS + 1) * 3
            if 8 * number * state.getNumPartitions() <= SUMS_BYTES:
                direct = {k: _smaller(growing[k], nodes, known[k], DERIVED_ROWS) for k, nodes in asked.items()}
                found = _met(_summed(state, light, _gradients(light, growing, direct, t, width)), 0)
                for k, nodes in asked.items():
                    if k in found:
                        own = found[k].reshape(len(direct[k]), width, BINS + 1, 3)
                        whole = _with_larger(growing[k], nodes, dict(zip(direct[k], own, strict=True)), known[k])
                        best = best_splits(whole, models[k].growth, growing[k].columns)
                    _answer(growing[k], nodes, best if k in found else None)
            else:
                columns = {k: growing[k].columns for k in asked}
                found = (_summed(state, light, _gradients(light, growing, asked, t, width))
                         .reduceByKey(lambda a, b: a + b, tasks)
                         .map(lambda r, columns=columns: (r[0], best_splits(
                             r[1].reshape(-1, width, BINS + 1, 3), light[r[0]].growth, columns[r[0]]))).collectAsMap())
                for k, nodes in asked.items():
                    _answer(growing[k], nodes, found.get(k))
            if before is not None:
                before.unpersist()
                before = None
        new = {k: g.tree() for k, g in growing.items()}
        for k, tree in new.items():
            models[k].trees.append(tree)
        if t + 1 < trees:
            before, state = state, state.mapPartitions(_advance(light, new))
            if (t + 1) % TREES_A_CHECKPOINT:
                state = state.persist(StorageLevel.MEMORY_AND_DISK)
            else:  # ends the lineage, and what a lost executor costs
                old, (state, path) = path, _store(rows.sparkSession, state)
                _dropped(state, old)
    state.unpersist()
    _dropped(state, path)
    return models


def _parent(growing: _Growing) -> dict[int, int]:
    return {c: p for p, children in enumerate(growing.children) if children for c in children}


def _smaller(growing: _Growing, nodes: list[int], known: dict[int, np.ndarray], most: int) -> list[int]:
    """The asked nodes whose sums must come from rows: of two children of a known node of ``most`` rows only the
    smaller."""
    parent, made = _parent(growing), []
    for node in nodes:
        p = parent.get(node)
        if p in known and growing.sums[p][2] >= most and set(growing.children[p]) <= set(nodes):
            least = min(growing.children[p], key=lambda c: (growing.sums[c][2], c))
            if node != least:
                continue
        made.append(node)
    return made


def _with_larger(growing: _Growing, nodes: list[int], found: dict[int, np.ndarray],
                 known: dict[int, np.ndarray]) -> np.ndarray:
    """The sums of all asked nodes, the larger children's derived; all become known."""
    parent = _parent(growing)
    for node in nodes:
        if node not in found:
            a, b = growing.children[parent[node]]
            rest = known[parent[node]] - found[b if node == a else a]
            rest[rest[..., 2] == 0] = 0.0  # what rounding leaves of no rows
            found[node] = rest
    known.update(found)
    return np.stack([found[node] for node in nodes])


def _gradients(models: list[Booster], growing: dict[int, _Growing], asked: dict[int, list[int]], t: int, width: int):
    """A block's sums for the asked nodes, which are leaves of the trees so far."""
    shapes = {k: growing[k].arrays() for k in asked}
    words = {k: _Words.of(*shape) for k, shape in shapes.items()}
    columns = {k: growing[k].columns for k in asked}
    slots = {}
    for k, nodes in asked.items():
        slots[k] = np.full(len(shapes[k][0]), -1, np.int16)
        slots[k][nodes] = np.arange(len(nodes))

    def rows_of(cut: _Cut, k: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
        """(place among the asked, its rows in their order)."""
        if words[k] is None:
            for node, own in _parted(*shapes[k], cut.columns(models[k], slice(0, size)), size):
                if slots[k][node] >= 0:
                    yield slots[k][node], own
            return
        slot = cut.by_leaf(words[k], models[k], words[k].by_place(slots[k].astype(np.int8), np.int8(-1)), size)
        own = np.flatnonzero(slot >= 0)
        part = slot.take(own)
        own = own.take(np.argsort(part, kind="stable"))
        ends = np.cumsum(np.bincount(part, minlength=len(asked[k])))
        for i, (a, b) in enumerate(zip([0, *ends], ends)):
            yield i, own[a:b]

    def sums(cut: _Cut, k: int, size: int, margin):
        if k not in asked:
            return None
        m = models[k]
        wanted = {0, *columns[k].tolist()}  # the first feature's bins give a node's whole sums
        made = np.zeros((len(asked[k]), width, BINS + 1, 3))
        for i, own in rows_of(cut, k, size):
            if m.growth.subsample < 1:
                own = own.take(np.flatnonzero(_drawn(cut.key.take(own), m.growth, t)))
            p = 1 / (1 + np.exp(-(margin.take(own) + m.base)))
            made[i] = cut.sums(m, own, wanted, p - cut.label.take(own), p * (1 - p))
        return made.ravel()

    return sums


def _advance(models: list[Booster], new: dict[int, Tree]):
    """Margins with the new trees."""
    def moved(cut: _Cut, k: int, size: int, margin: np.ndarray) -> np.ndarray:
        if k not in new:
            return margin
        if (words := new[k].words()) is None:
            return margin + new[k].margins(cut.columns(models[k], slice(0, size)), size)
        return margin + cut.by_leaf(words, models[k], words.by_place(new[k].value), size)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for row in rows:
            made = [moved(cut, *own) for cut in [_Cut(*row, models)] for own in cut.own]
            yield *row[:4], np.concatenate(made).astype("<f8").tobytes() if made else b""

    return run


# ---- scoring ---------------------------------------------------------------------


def _raw(batch: pa.RecordBatch, at: Sequence[int]) -> np.ndarray:
    columns = [batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in at]
    return np.column_stack(columns).astype(float) if columns else np.empty((batch.num_rows, 0))


def _with(df: DataFrame, cols: Sequence[str], added: str, types: dict[str, T.DataType], make) -> DataFrame:
    at = [df.columns.index(c) for c in cols]
    schema = T.StructType([*df.schema, *[T.StructField(n, t) for n, t in types.items()]])
    names = [*df.columns, *types]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *make(_raw(batch, at))], names=names)

    return df.mapInArrow(run, schema)


def score(df: DataFrame, model: Booster, cols: Sequence[str], out_col: str = "churn_prob_raw") -> DataFrame:
    """Adds the probability of label 1."""
    return _with(df, cols, out_col, {out_col: T.DoubleType()}, lambda raw: [
        pa.array(1 / (1 + np.exp(-model.margin(model.bins(raw)))))])


def occluded(df: DataFrame, model: Booster, cols: Sequence[str], fills: Sequence[float], out_cols: Sequence[str]) -> DataFrame:
    """Adds the probability of label 1, and that with each feature in turn at its value of ``fills``."""
    def make(raw: np.ndarray) -> list[pa.Array]:
        bins = model.bins(raw)
        put = model.bins(np.array([fills], float))[0]
        return [pa.array(1 / (1 + np.exp(-m))) for m in model.occluded(bins, put)]

    return _with(df, cols, "occluded", {c: T.DoubleType() for c in out_cols}, make)


def explain(df: DataFrame, model: Booster, cols: Sequence[str]) -> DataFrame:
    """Adds ``base_value``, ``margin`` and ``contributions`` (feature, contribution), which add up to it."""
    kind = T.ArrayType(T.StructType([T.StructField("feature", T.StringType()),
                                     T.StructField("contribution", T.DoubleType())]))
    names = list(cols)

    def make(raw: np.ndarray) -> list[pa.Array]:
        base, made = model.contributions(model.bins(raw))
        flat = pa.StructArray.from_arrays([pa.array(names * len(raw), pa.string()), pa.array(made.ravel())],
                                          names=["feature", "contribution"])
        ends = pa.array(np.arange(len(raw) + 1, dtype=np.int32) * len(names), pa.int32())
        return [pa.array(np.full(len(raw), base)), pa.array(base + made.sum(axis=1)),
                pa.ListArray.from_arrays(ends, flat)]

    return _with(df, cols, "contributions", {"base_value": T.DoubleType(), "margin": T.DoubleType(),
                                             "contributions": kind}, make)


def importance(df: DataFrame, model: Booster, cols: Sequence[str]) -> DataFrame:
    """feature, importance: the mean size of a feature's contributions over the rows."""
    return (explain(df, model, cols).select(F.explode("contributions").alias("c"))
            .groupBy(F.col("c.feature").alias("feature"))
            .agg(F.avg(F.abs("c.contribution")).alias("importance"))
            .orderBy(F.desc("importance"), "feature"))


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at least ``most``, but for the last."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def score_windows(df: DataFrame, models: list[Booster], windows: list[list[tuple[int, int, str]]], cols: Sequence[str],
                  month_col: str, keep: Sequence[str]) -> DataFrame:
    """Rows of several models at once: model (its number), use, ``keep`` and churn_prob_raw. ``windows``: for
    each model (first month, last month, use); ``month_col`` holds the month's number."""
    at = [df.columns.index(c) for c in cols]
    kept, where = [df.columns.index(c) for c in keep], df.columns.index(month_col)
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("use", T.StringType()),
                           *[df.schema[c] for c in keep], T.StructField("churn_prob_raw", T.DoubleType())])

    shared = df.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in _gathered(batches, WINDOW_ROWS):
            month = batch.column(where).to_numpy(zero_copy_only=False)
            bins = quantised(_raw(batch, at), models[0].edges)
            for k, (model, uses) in enumerate(zip(models, windows, strict=True)):
                for first, last, use in uses:
                    rows = np.flatnonzero((month >= first) & (month <= last))
                    if not len(rows):
                        continue
                    taken = batch.take(pa.array(rows))
                    p = 1 / (1 + np.exp(-model.margin(filled(bins[rows], model.medians))))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), k, np.int32)), pa.array([use] * len(rows)),
                         *[taken.column(i) for i in kept], pa.array(p)],
                        names=["k", "use", *keep, "churn_prob_raw"])

    return df.mapInArrow(run, schema)


# ---- calibration -----------------------------------------------------------------


def platt(scored: DataFrame, by: str, raw: str = "churn_prob_raw", label: str = LABEL, steps: int = 50,
          tolerance: float = 1e-10) -> DataFrame:
    """(by, a, b): p = 1 / (1 + exp(-(a x + b))) of each group by Newton steps on the log loss with a ** 2 / 2,
    each step from one row of sums a group. Groups of one label have no finite b: after ``steps`` they keep
    the last one."""
    spark = scored.sparkSession
    rows = scored.select(F.col(by).alias("g"), F.col(raw).alias("x"), F.col(label).cast("double").alias("y")).filter(
        "y IS NOT NULL AND x IS NOT NULL")
    kind = f"g {scored.schema[by].dataType.simpleString()}, a double, b double"
    fit = {r["g"]: (0.0, 0.0) for r in rows.select("g").distinct().collect()}  # a row a model
    for _ in range(steps):
        now = spark.createDataFrame([(g, a, b) for g, (a, b) in fit.items()], kind)
        p = 1 / (1 + F.exp(-(F.col("a") * F.col("x") + F.col("b"))))
        sums = (rows.join(F.broadcast(now), "g").select("g", "x", (p - F.col("y")).alias("r"), (p * (1 - p)).alias("h"))
                .groupBy("g").agg(F.sum("r").alias("gb"), F.sum(F.col("r") * F.col("x")).alias("ga"),
                                  F.sum("h").alias("hbb"), F.sum(F.col("h") * F.col("x")).alias("hab"),
                                  F.sum(F.col("h") * F.col("x") * F.col("x")).alias("haa")).collect())
        change = 0.0
        for s in sums:
            a, b = fit[s["g"]]
            ga, haa, hbb = s["ga"] + a, s["haa"] + 1.0, s["hbb"] + 1e-12
            det = haa * hbb - s["hab"] ** 2
            if det <= 0:
                continue
            da, db = (hbb * ga - s["hab"] * s["gb"]) / det, (haa * s["gb"] - s["hab"] * ga) / det
            da, db = (max(-4.0, min(4.0, d)) for d in (da, db))
            fit[s["g"]] = (a - da, b - db)
            change = max(change, abs(da), abs(db))
        if change < tolerance:
            break
    return spark.createDataFrame([(g, a, b) for g, (a, b) in fit.items()], kind)
