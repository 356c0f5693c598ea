"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation (operator 12).

Each component becomes an integer, floor(256 * x). The fit list holds every distinct integer vector
once. Its centred rows are the matrix X, which stays distributed: steps alternate the products
X v and Xᵀ u, both orthogonalised in full against all vectors before, which leaves a small
bidiagonal matrix B with X V = U B. The singular values of B over the root of n are the
deviations, and V turns its right singular vectors into the components.

The left vectors are as long as the fit list and are never stored: u = X w, with a w of one
vector's length that the driver carries along, so a pass computes every row of U anew from the row of X.
A lost executor loses nothing but its pass. A step takes two passes: X v and its products with
all u before, then Xᵀ u. Each gives one partial row of sums a task. Rows of the fit list are written
as packed blocks, so that a pass is a few matrix products a block.

By default there are as many steps as dimensions, which finds equal deviations too: where the
residual vanishes, the process goes on from a new vector orthogonal to those before.

Defined results: rows with a null vector, or null or non-finite components, are left out;
components whose floor leaves the range of long are the nearest long; shorter
vectors count as padded with zeros; rows with a null id, repeated rows and repeated ids are
whitened each; equal deviations may come in any rotation, the same for all rows; components
without deviation (fewer distinct vectors than components, constant tables) have no rows, and an
empty table has none; a sum of squares beyond long is null; columns beyond id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import written

SCALE, COMPONENTS = 256, 4
# Vectors of one packed block.
BLOCK_ROWS = 4096
# Relative size at which a vector counts as zero: the rounding of the sums that it is made of.
NOTHING = 1e-11
_SEED = 20240712
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums per dimension; components in rows with their eigenvalues, greatest first."""
    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def quantised(vector: Column) -> Column:
    """floor(SCALE * x) of each component, null if the vector takes no part."""
    whole = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.when(whole, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    rows = np.zeros((len(sizes), width), np.int64)
    rows[np.repeat(np.arange(len(sizes)), sizes),
         np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return rows


def packed(distinct: DataFrame, width: int, kind: str) -> DataFrame:
    """(q) -> (n, data): BLOCK_ROWS vectors a row, as integers of a kind that holds all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block() -> pa.RecordBatch:
            data = np.concatenate(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([len(data)], pa.int32()), pa.array([data.astype(kind).tobytes()], pa.binary())],
                names=["n", "data"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(matrix(batch.column(0).slice(at, BLOCK_ROWS), width))
                n += len(held[-1])
                if n >= BLOCK_ROWS:
                    yield block()
                    held, n = [], 0
        if n:
            yield block()

    return distinct.mapInArrow(run, "n int, data binary")


def kind_for(low: int, high: int) -> str:
    return next((k for k in ("<i2", "<i4") if np.iinfo(k).min <= low and high <= np.iinfo(k).max), "<i8")


def summed(blocks: DataFrame, kind: str, mean: np.ndarray, size: int,
           of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``of``(centred rows), ``size`` numbers: one partial row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = np.frombuffer(data.as_buffer(), kind).reshape(n, len(mean))
                total += of(rows - mean)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["s"])

    parts = blocks.mapInArrow(run, "s array<double>")
    whole = parts.select(F.posexplode("s").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    made = np.zeros(size)
    for i, x in whole.collect():  # ``size`` numbers, a few hundred
        made[i] = x
    return made


def _orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            vector = vector - b * (b @ vector)
    return vector


def bidiagonalised(blocks: DataFrame, kind: str, mean: np.ndarray, scale: float, steps: int
                   ) -> tuple[np.ndarray, np.ndarray]:
    """(V, B) after ``steps`` steps: right vectors in columns, the upper bidiagonal matrix.
    ``scale`` is the Frobenius norm of X."""
    width = len(mean)
    rng = np.random.default_rng(_SEED)

    def fresh(basis: list[np.ndarray]) -> np.ndarray:
        v = _orthogonal(rng.standard_normal(width), basis)
        return v / np.linalg.norm(v)

    right, left = [fresh([])], []          # v_1.., and w_1.. with u = X w
    alphas, betas = [], []
    while True:
        v, w = right[-1], np.stack(left, axis=1) if left else np.zeros((width, 0))
        k = w.shape[1]

        def along(x: np.ndarray) -> np.ndarray:
            return (x @ w).T @ (x @ v)

        # u = X v less its parts along all u before; twice, since the first leaves rounding
        p = v
        if k:
            h = summed(blocks, kind, mean, k, along)
            p = v - w @ h

        def back(x: np.ndarray) -> np.ndarray:
            u = x @ p
            return np.concatenate([x.T @ u, (x @ w).T @ u, [u @ u]])

        made = summed(blocks, kind, mean, width + k + 1, back)
        rest, square = made[width:width + k], made[-1]
        r = made[:width]
        alpha = max(square - rest @ rest, 0.0) ** 0.5
        if alpha > NOTHING * scale:
            # Xᵀ (u - U rest) = Xᵀ u - Xᵀ U rest, and Xᵀ u_i = alpha_i v_i + beta_i v_{i+1}
            for i in range(k):
                r = r - rest[i] * (alphas[i] * right[i] + betas[i] * right[i + 1])
            left.append((p - w @ rest) / alpha)
            r = r / alpha - alpha * v
        else:
            alpha, r = 0.0, np.zeros(width)
            left.append(np.zeros(width))
        alphas.append(alpha)
        if len(right) >= steps:
            break
        r = _orthogonal(r, right)
        beta = float(np.linalg.norm(r))
        if beta > NOTHING * scale:
            betas.append(beta)
            right.append(r / beta)
        else:
            betas.append(0.0)
            right.append(fresh(right))
    # Xᵀ u_i has alpha_i on v_i and beta_i on v_{i+1}
    return np.stack(right, axis=1), np.diag(alphas) + np.diag(betas, 1)


def fit(distinct: DataFrame, components: int = COMPONENTS, steps: int | None = None) -> Whitening | None:
    """The whitening of a written table (q) of distinct integer vectors; None if it is empty."""
    n, width, low, high = distinct.agg(
        F.count(F.lit(1)), F.max(F.size("q")), F.min(F.array_min("q")), F.max(F.array_max("q"))).first()
    if not n or not width:
        return None
    sums = {r["i"]: int(r["s"]) for r in distinct.select(F.posexplode("q").alias("i", "x")).groupBy("i").agg(
        F.sum(F.col("x").cast("decimal(20,0)")).alias("s")).collect()}  # a row a dimension
    sums = tuple(sums.get(i, 0) for i in range(width))
    mean = np.array([s / n for s in sums])
    kind = kind_for(low, high)
    blocks = written(packed(distinct, width, kind), "fit-blocks").persist()
    square = float(summed(blocks, kind, mean, 1, lambda x: np.array([(x * x).sum()]))[0])
    made = Whitening(n, sums, np.zeros((0, width)), np.zeros(0), square / n)
    if square > 0:
        v, b = bidiagonalised(blocks, kind, mean, square ** 0.5, min(steps or width, width))
        _, deviations, turned = np.linalg.svd(b)
        e = deviations[:components] ** 2 / n
        e = e[e > (NOTHING * deviations[0]) ** 2 / n]
        found = (v @ turned.T)[:, :len(e)].T
        found /= np.linalg.norm(found, axis=1, keepdims=True)
        k = len(e)

        def spread(x: np.ndarray) -> np.ndarray:
            y = x @ found.T / np.sqrt(e)
            return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

        moments = summed(blocks, kind, mean, k + k * k, spread) / n
        covariance = moments[k:].reshape(k, k) - np.outer(moments[:k], moments[:k])
        made = Whitening(n, sums, found, e, square / n, float(np.abs(covariance - np.eye(k)).max(initial=0)))
    blocks.unpersist()
    return made


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """The exact sum of (n x - S) ** 2 of each row."""
    size = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1) * model.n + max(map(abs, model.sums))
    if size * size * x.shape[1] <= _LONG:
        d = model.n * x - np.array(model.sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    found = [sum((model.n * c - s) ** 2 for c, s in zip(row, model.sums, strict=True)) for row in x.tolist()]
    return [f if f <= _LONG else None for f in found]


def apply(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vectors``: id, q. -> a row for each vector and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    k, width, mean = len(model.eigenvalues), len(model.sums), model.mean
    turn = model.components.T / np.sqrt(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), width)
            n = len(x)
            each = np.repeat(np.arange(n), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                 pa.array(np.full(n * k, model.n)),
                 pa.array(_deviations(x, model), pa.int64()).take(pa.array(each)),
                 pa.array(((x - mean) @ turn).ravel()), pa.array(np.tile(model.eigenvalues / model.trace, n)),
                 pa.array(np.full(n * k, model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select("id", "q").mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, "
             "identity_error double")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS, steps: int | None = None) -> DataFrame:
    """Fits on the distinct vectors and whitens all rows: see ``apply``."""
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col)).alias("q"))
            .filter("q IS NOT NULL"))
    model = fit(written(rows.select("q").distinct(), "fit-list"), components, steps)
    if model is None or not len(model.eigenvalues):
        rows, model = rows.limit(0), Whitening(1, (0,), np.zeros((0, 1)), np.zeros(0), 1.0)
    return apply(rows, model)
