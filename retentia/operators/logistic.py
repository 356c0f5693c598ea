"""Logistic regressions for many training windows at once (O-47, O-51, O-90, O-91).

Rows become blocks of doubles in the order of their months, persisted on the executors; a window is a range of each
block. All windows share their passes: exact medians by counting between pivots, means and deviations, and
then the steps of the optimiser. Every window has an optimiser of its own on the driver, which is that of ``pyspark.ml``
(L-BFGS of ten steps with a strong Wolfe line search, the same starting point, scaling and stopping rule): a
pass evaluates the points that all of them ask for. The driver holds sums and coefficients, never rows.

Nulls and NaN take the window's median, a column that is constant in a window gets no weight, as in
``models.build_model``.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 17
TASK_ROWS = 1 << 21  # of the blocks that a task reads one after the other, at most
CHUNK_ROWS = 1 << 12  # of a block that are evaluated together
PIVOTS = 1000  # values of a column that a pass counts between, shared by its open cells
CELL_PIVOTS = 16  # of an open cell, at least


@dataclass
class Fit:
    """A window's model: medians, means, deviations (0: constant), coefficients of the standardised features and
    intercept; ``a`` and ``b`` calibrate its probability."""
    medians: np.ndarray
    mean: np.ndarray
    std: np.ndarray
    coef: np.ndarray
    intercept: float
    a: float = 1.0
    b: float = 0.0

    def scale(self) -> np.ndarray:
        return np.divide(1.0, self.std, out=np.zeros_like(self.std), where=self.std != 0)


# ---- blocks ----------------------------------------------------------------------


def blocks(df: DataFrame, cols: Sequence[str], month: Column, label: Column, n: int) -> RDD:
    """(rows, bytes) of blocks by month: months, labels, a column of doubles after the other, NaN for null."""
    value = F.array(*[F.coalesce(F.col(c).cast("double") + F.lit(0.0), F.lit(float("nan"))) for c in cols])
    rows = df.select(month.cast("int").alias("month"), label.cast("int").alias("label"), value.alias("x"))
    width = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            months, labels, x = (np.concatenate(p) for p in zip(*held, strict=True))
            order = np.argsort(months, kind="stable")
            data = (months[order].astype("<i4").tobytes() + labels[order].astype("u1").tobytes()
                    + np.ascontiguousarray(x[order].T).astype("<f8").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([len(order)], pa.int32()), pa.array([data], pa.binary())],
                                              names=["n", "data"])

        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), x))
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield block()
                held, size = [], 0
        if held:
            yield block()

    slots = df.sparkSession.sparkContext.defaultParallelism
    parts = -(-n // (slots * TASK_ROWS)) * slots if n > slots << 12 else 1
    made = rows.repartition(parts).mapInArrow(run, "n int, data binary").rdd.map(lambda r: (r[0], bytes(r[1])))
    return made.persist(StorageLevel.MEMORY_AND_DISK)


class _Block:
    def __init__(self, n: int, data: bytes, width: int) -> None:
        self.n = n
        self.month = np.frombuffer(data, "<i4", n)
        self.label = np.frombuffer(data, "u1", n, 4 * n).astype(float)
        self.x = np.frombuffer(data[5 * n:], "<f8", n * width).reshape(width, n)  # features x rows

    def range(self, first: int, last: int) -> tuple[int, int]:
        return (int(np.searchsorted(self.month, first, "left")), int(np.searchsorted(self.month, last, "right")))


def _added(state: RDD, make, width: int, by_key: bool = False) -> dict:
    """Arrays by key, added over all blocks; ``make(block)`` gives (key, array) pairs. Large arrays meet ``by_key``
    before they come to the driver."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        totals: dict = {}
        for n, data in rows:
            for key, x in make(_Block(n, data, width)):
                totals[key] = totals[key] + x if key in totals else x
        yield from totals.items()

    made = state.mapPartitions(run)
    if by_key and state.getNumPartitions() > 1:
        made = made.reduceByKey(lambda a, b: a + b, min(state.getNumPartitions(), state.ctx.defaultParallelism))
    totals: dict = {}
    for key, x in made.collect():
        totals[key] = totals[key] + x if key in totals else x
    return totals


# ---- medians, means and deviations of windows ------------------------------------


def _spread(x: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` of ascending values, the ends among them."""
    return x if len(x) <= most else x[np.linspace(0, len(x) - 1, most).astype(int)]


def _pivots(state: RDD, width: int, cells: dict[int, list[tuple[float, float]]]) -> dict[int, np.ndarray]:
    """New pivots of columns inside their open cells (low, high): all values, if they are few, or quantiles of the
    blocks' values."""
    share = {f: max(CELL_PIVOTS, PIVOTS // len(own)) for f, own in cells.items()}

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for n, data in rows:
            block = _Block(n, data, width)
            for f, own in cells.items():
                x = block.x[f]
                x = np.sort(x[~np.isnan(x)])
                for low, high in own:
                    a = 0 if low == -np.inf else int(np.searchsorted(x, low, "right"))
                    b = len(x) if high == np.inf else int(np.searchsorted(x, high, "left"))
                    if a < b:
                        yield (f, low), np.unique(_spread(x[a:b], share[f]))

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(np.concatenate([a, b]))

    tasks, found = min(state.getNumPartitions(), state.ctx.defaultParallelism), {}
    thinned = state.mapPartitions(run).reduceByKey(joined, tasks).map(lambda r: (r[0], _spread(r[1], share[r[0][0]])))
    for (f, _), x in thinned.collect():
        found.setdefault(f, []).append(x)
    return {f: np.unique(np.concatenate(x)) for f, x in found.items()}


def window_medians(state: RDD, width: int, lasts: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Windows x features: the exact medians (the mean of the two middle values; NaN without a value) of the rows
    up to each month of ``lasts``, ascending; and a centre and a scale of each feature for steadier sums."""
    ends = np.array(lasts)
    made = np.full((len(ends), width, 2), np.nan)
    centre = np.array([np.zeros(width), np.ones(width)])
    cells = {f: [(-np.inf, np.inf)] for f in range(width)}
    waiting = {f: [(k, i) for k in range(len(ends)) for i in range(2)] for f in range(width)}
    first = True
    while waiting:
        pivots = _pivots(state, width, cells)
        if first:
            for f, x in pivots.items():
                near = x[np.isfinite(x)]
                if len(near):
                    centre[:, f] = near.mean(), near.std() or 1.0
            first = False
        for f in [f for f in waiting if f not in pivots]:  # no value at all
            del waiting[f]

        def counts(block: _Block, pivots=pivots):
            part = np.searchsorted(ends, block.month, "left")  # the first window that holds the row
            for f, cut in pivots.items():
                x = block.x[f]
                own = np.flatnonzero(~np.isnan(x) & (part < len(ends)))
                cell = np.searchsorted(cut, x[own], "left") + np.searchsorted(cut, x[own], "right")
                size = 2 * len(cut) + 1
                yield f, np.bincount(part[own] * size + cell, minlength=len(ends) * size).reshape(len(ends), size)

        by = _added(state, counts, width, by_key=True)
        cells, still = {}, {}
        for f, own in waiting.items():
            below = np.cumsum(np.cumsum(by[f], axis=0), axis=1)
            cut, opened = pivots[f], set()
            for k, i in own:
                n = int(below[k, -1])
                if not n:
                    continue
                rank = (n + 1) // 2 if i == 0 else n // 2 + 1
                cell = int(np.searchsorted(below[k], rank, "left"))
                if cell % 2:
                    made[k, f, i] = cut[cell // 2]
                else:
                    at = cell // 2
                    low, high = cut[at - 1] if at else -np.inf, cut[at] if at < len(cut) else np.inf
                    opened.add((float(low), float(high)))
                    still.setdefault(f, []).append((k, i))
            if opened:
                cells[f] = sorted(opened)
        waiting = still
    low, high = made[..., 0], made[..., 1]
    return np.where(low == high, low, (low + high) / 2), centre


def _moments(state: RDD, width: int, lasts: Sequence[int], centre: np.ndarray) -> dict[str, np.ndarray]:
    """Windows x features: sums, sums of squares (both after centring), nulls, least and greatest value; windows:
    rows and sums of labels."""
    ends = np.array(lasts)

    def sums(rows: Iterator[tuple]) -> Iterator[tuple]:
        made = np.zeros((len(ends), width, 3))
        extreme = np.full((len(ends), width, 2), np.inf)
        whole = np.zeros((len(ends), 2))
        for n, data in rows:
            block = _Block(n, data, width)
            at = [0, *[int(np.searchsorted(block.month, m, "right")) for m in ends]]
            for k, (a, b) in enumerate(zip(at, at[1:])):
                if b <= a:
                    continue
                whole[k] += b - a, block.label[a:b].sum()
                for f in range(width):
                    x = block.x[f, a:b]
                    empty = np.isnan(x)
                    if empty.any():
                        x = x[~empty]
                    z = (x - centre[0, f]) / centre[1, f]
                    made[k, f] += z.sum(), z @ z, empty.sum()
                    if len(x):
                        extreme[k, f] = np.minimum(extreme[k, f], (x.min(), -x.max()))
        yield 0, (made, extreme, whole)

    parts = [x for _, x in state.mapPartitions(sums).collect()]
    made, whole = (np.cumsum(sum(p[i] for p in parts), axis=0) for i in (0, 2))
    extreme = np.minimum.accumulate(np.minimum.reduce([p[1] for p in parts]), axis=0)
    return {"sum": made[..., 0], "squares": made[..., 1], "nulls": made[..., 2], "low": extreme[..., 0],
            "high": -extreme[..., 1], "n": whole[:, 0], "positive": whole[:, 1]}


# ---- the optimiser ---------------------------------------------------------------

Steps = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


class _NoStep(Exception):
    pass


def _between(left, right) -> float:
    """The least point of the cubic through two points (place, slope, value), kept from their ends."""
    d1 = left[1] + right[1] - 3 * (left[2] - right[2]) / (left[0] - right[0])
    d2 = np.sqrt(d1 * d1 - left[1] * right[1])
    t = right[0] - (right[0] - left[0]) * (right[1] + d2 - d1) / (right[1] - left[1] + 2 * d2)
    least, most = (left[0] + s * (right[0] - left[0]) for s in (0.1, 0.9))
    return least if t < least else most if t > most else t


def _line_search(x: np.ndarray, value: float, grad: np.ndarray, step: np.ndarray, start: float):
    """-> (place on the line, point, value, gradient) by the strong Wolfe conditions."""
    slope = float(grad @ step)
    if slope > 0:
        raise _NoStep

    def at(t: float):
        point = x + step * t
        f, g = yield point
        return (t, float(g @ step), f), (t, point, f, g)

    def enough(c) -> bool:
        return c[2] <= value + 1e-4 * c[0] * slope

    def zoom(low, high):
        for _ in range(10):
            c, made = yield from at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if not enough(c) or c[2] >= low[2]:
                high = c
            else:
                if abs(c[1]) <= 0.9 * abs(slope):
                    return made
                if c[1] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _NoStep

    t, low = start, (0.0, slope, value)
    for i in range(10):
        c, made = yield from at(t)
        if not np.isfinite(c[2]):
            t /= 2
            continue
        if not enough(c) or (c[2] >= low[2] and i > 0):
            return (yield from zoom(low, c))
        if abs(c[1]) <= 0.9 * abs(slope):
            return made
        if c[1] >= 0:
            return (yield from zoom(c, low))
        low = c
        t *= 1.5
    raise _NoStep


def _direction(grad: np.ndarray, steps: list[np.ndarray], changes: list[np.ndarray]) -> np.ndarray:
    """Newest pairs first."""
    made, shares = grad.copy(), []
    diag = 1.0
    if steps:
        sy = steps[0] @ changes[0]
        if not sy >= 0:
            raise _NoStep
        diag = sy / (changes[0] @ changes[0])
    for s, y in zip(steps, changes):
        shares.append((s @ made) / (s @ y))
        if np.isnan(shares[-1]):
            raise _NoStep
        made -= shares[-1] * y
    made *= diag
    for s, y, share in zip(reversed(steps), reversed(changes), reversed(shares)):
        made += (share - (y @ made) / (s @ y)) * s
    return -made


def minimised(x: np.ndarray, max_iter: int, tolerance: float, memory: int = 10, remembered: int = 20) -> Steps:
    """Yields points, takes (value, gradient) there, returns the last point."""
    value, grad = yield x
    first, values = value, [np.inf]
    steps: list[np.ndarray] = []
    changes: list[np.ndarray] = []
    iteration, failed = 0, False
    while True:
        if (iteration >= max_iter >= 0 or (len(values) >= 2 and abs(value - max(values)) <= tolerance * first)
                or np.linalg.norm(grad) <= max(tolerance * value, 1e-8)):
            return x
        try:
            step = _direction(grad, steps, changes)
            start = 1.0 / np.linalg.norm(step) if iteration == 0 else 1.0
            t, point, new, slope = yield from _line_search(x, value, grad, step, start)
            if t * np.linalg.norm(grad) < 1e-10:
                raise _NoStep
        except _NoStep:
            if failed:
                return x
            failed, steps, changes = True, [], []
            continue
        steps, changes = [point - x, *steps][:memory], [slope - grad, *changes][:memory]
        x, value, grad = point, new, slope
        values = [*values, value][-remembered:]
        iteration, failed = iteration + 1, False


def _answered(runs: dict[int, Steps], evaluate) -> dict[int, np.ndarray]:
    """Runs all optimisers side by side: ``evaluate({k: point})`` gives {k: (value, gradient)} in one pass."""
    asked, done = {k: next(run) for k, run in runs.items()}, {}
    while asked:
        found = evaluate(asked)
        for k in list(asked):
            try:
                asked[k] = runs[k].send(found[k])
            except StopIteration as end:
                done[k] = end.value
                del asked[k]
    return done


# ---- sums over the rows of windows -----------------------------------------------


def _chunks(block: _Block, ranges: dict[int, tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """(first row, last row, windows) of stretches that lie wholly inside or outside of each window."""
    at = {k: block.range(*r) for k, r in ranges.items()}
    cuts = sorted({x for r in at.values() for x in r})
    for a, b in zip(cuts, cuts[1:]):
        own = [k for k, (low, high) in at.items() if low <= a and b <= high]
        if own:
            for c in range(a, b, CHUNK_ROWS):
                yield c, min(c + CHUNK_ROWS, b), own


def _margins(block: _Block, a: int, b: int, centre: np.ndarray, weights: np.ndarray, fills: np.ndarray):
    """Centred rows, their nulls (None: none) and the margins of columns of ``weights`` (features, then the start)."""
    z = (block.x[:, a:b] - centre[0][:, None]) / centre[1][:, None]
    empty = np.isnan(z)
    if not empty.any():
        return z, None, z.T @ weights[:-1] + weights[-1]
    z[empty] = 0.0
    empty = empty.astype(float)
    return z, empty, z.T @ weights[:-1] + empty.T @ (fills * weights[:-1]) + weights[-1]


def _loss(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log losses, probabilities less labels, and the probabilities."""
    small = np.exp(-np.abs(margin))
    p = np.where(margin >= 0, 1.0, small) / (1.0 + small)
    return np.log(1.0 + small) + np.maximum(margin, 0.0) - label * margin, p - label, p


def fit_windows(state: RDD, width: int, lasts: Sequence[int], names: Sequence[str], c: float, max_iter: int,
                tolerance: float) -> tuple[list[Fit], np.ndarray]:
    """A regression on the rows up to each month of ``lasts`` (ascending), each window holding both labels."""
    medians, centre = window_medians(state, width, lasts)
    if np.isnan(medians).any():
        raise ValueError(f"no training value in columns {[names[f] for f in range(width) if np.isnan(medians[:, f]).any()]}")
    fills = (medians - centre[0]) / centre[1]
    found = _moments(state, width, lasts, centre)
    n, nulls = found["n"], found["nulls"]
    mean = (found["sum"] + nulls * fills) / n[:, None]
    squares = found["squares"] + nulls * fills ** 2 - n[:, None] * mean ** 2
    std = np.sqrt(np.maximum(squares, 0.0) / np.maximum(n - 1, 1)[:, None])
    constant = (found["low"] == found["high"]) & ((nulls == 0) | (medians == found["low"]))
    std = np.where(constant, 0.0, std)  # of the centred values
    scale = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
    size = np.maximum(n, 2)
    penalty = (size - 1) / (c * size * size)
    ranges = {k: (-(1 << 31), m) for k, m in enumerate(lasts)}

    def evaluate(asked: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        weights = {k: np.append(x[:-1] * scale[k], x[-1] - (x[:-1] * scale[k]) @ mean[k]) for k, x in asked.items()}
        own, put = {k: ranges[k] for k in asked}, {k: fills[k] for k in asked}

        def sums(block: _Block):
            made = {k: np.zeros(2 + width) for k in own}
            for a, b, held in _chunks(block, own):
                filled = np.column_stack([put[k] for k in held])
                z, empty, margin = _margins(block, a, b, centre, np.column_stack([weights[k] for k in held]), filled)
                loss, rest, _ = _loss(margin, block.label[a:b, None])
                by = z @ rest
                if empty is not None:
                    by += filled * (empty @ rest)
                for i, x in enumerate(np.vstack([loss.sum(axis=0), rest.sum(axis=0), by]).T):
                    made[held[i]] += x
            yield 0, np.vstack([made[k] for k in own])

        by = dict(zip(own, _added(state, sums, width)[0], strict=True))
        made = {}
        for k, x in asked.items():
            loss, rest, raw = by[k][0], by[k][1], by[k][2:]
            grad = np.append((raw - rest * mean[k]) * scale[k], rest) / n[k]
            grad[:-1] += penalty[k] * x[:-1]
            made[k] = loss / n[k] + 0.5 * penalty[k] * float(x[:-1] @ x[:-1]), grad
        return made

    start = np.log(found["positive"] / (n - found["positive"]))
    done = _answered({k: minimised(np.append(np.zeros(width), start[k]), max_iter, tolerance)
                      for k in range(len(lasts))}, evaluate)
    return [Fit(medians[k], mean[k] * centre[1] + centre[0], std[k] * centre[1], done[k][:-1], float(done[k][-1]))
            for k in range(len(lasts))], centre


def calibrate_windows(state: RDD, width: int, fits: list[Fit], spans: Sequence[tuple[int, int]], centre: np.ndarray,
                      max_iter: int, tolerance: float) -> None:
    """Sets ``a`` and ``b`` of each fit from the rows of its span of months, which hold both labels."""
    weights, fills = {}, {}
    for k, fit in enumerate(fits):
        w = fit.coef * fit.scale()
        weights[k] = np.append(w * centre[1], fit.intercept + (centre[0] - fit.mean) @ w)
        fills[k] = (fit.medians - centre[0]) / centre[1]

    def passed(points: dict[int, tuple], make, size: int) -> dict[int, np.ndarray]:
        """Sums by window of ``make(points, probabilities, labels)``: a row of ``size`` a window."""
        own = {k: spans[k] for k in points}

        def sums(block: _Block):
            made = {k: np.zeros(size) for k in own}
            for a, b, held in _chunks(block, own):
                _, _, margin = _margins(block, a, b, centre, np.column_stack([weights[k] for k in held]),
                                        np.column_stack([fills[k] for k in held]))
                label = block.label[a:b, None]
                _, _, p = _loss(margin, label)
                for i, x in enumerate(make(np.array([points[k] for k in held]).T, p, label).T):
                    made[held[i]] += x
            yield 0, np.vstack([made[k] for k in own])

        return dict(zip(own, _added(state, sums, width)[0], strict=True))

    def moments(at, p, label):
        d = p - at[0]
        return np.vstack([d.sum(axis=0), (d * d).sum(axis=0), np.full(p.shape[1], len(p)),
                          np.full(p.shape[1], label.sum()), np.zeros(p.shape[1])])

    ks = range(len(fits))
    rough = passed({k: (0.0,) for k in ks}, moments, 5)
    mean = {k: x[0] / x[2] for k, x in rough.items()}
    found = passed({k: (mean[k],) for k in ks}, moments, 5)
    n = {k: x[2] for k, x in found.items()}
    std = {k: float(np.sqrt(x[1] / max(x[2] - 1, 1))) for k, x in found.items()}
    std = {k: s if s > 1e-14 else 0.0 for k, s in std.items()}  # rounding of a constant

    def losses(at, p, label):
        d = p * at[0] - at[1]
        loss, rest, _ = _loss(d * at[2] + at[3], label)
        return np.vstack([loss.sum(axis=0), (rest * d).sum(axis=0), rest.sum(axis=0)])

    def evaluate(asked: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        scale = {k: 1.0 / std[k] if std[k] else 0.0 for k in asked}
        by = passed({k: (scale[k], mean[k] * scale[k], x[0], x[1]) for k, x in asked.items()}, losses, 3)
        made = {}
        for k, x in asked.items():
            pull = x[0] * scale[k] * scale[k] / n[k]  # the penalty weighs the unscaled coefficient, 1 / n
            made[k] = by[k][0] / n[k] + 0.5 * x[0] * pull, np.array([by[k][1] / n[k] + pull, by[k][2] / n[k]])
        return made

    start = {k: np.log(x[3] / (x[2] - x[3])) for k, x in found.items()}
    done = _answered({k: minimised(np.array([0.0, start[k]]), max_iter, tolerance) for k in ks}, evaluate)
    for k, fit in enumerate(fits):
        fit.a = float(done[k][0] / std[k]) if std[k] else 0.0
        fit.b = float(done[k][1] - fit.a * mean[k])


def probability(fit_col: str, cols: Sequence[str]) -> Column:
    """The raw probability of a row from the parameters beside it (a struct of arrays, see ``parameters``)."""
    p = F.col(fit_col)
    margin = p["intercept"]
    for i, c in enumerate(cols):
        x = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), p["medians"][i])
        margin = margin + (x - p["mean"][i]) * p["scale"][i] * p["coef"][i]
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


PARAMETERS = ("struct<medians:array<double>,mean:array<double>,scale:array<double>,coef:array<double>,"
              "intercept:double,a:double,b:double>")


def parameters(fit: Fit) -> tuple:
    return (fit.medians.tolist(), fit.mean.tolist(), fit.scale().tolist(), fit.coef.tolist(), fit.intercept, fit.a, fit.b)
