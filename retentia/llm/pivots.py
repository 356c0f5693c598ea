"""Embedding near-duplicates by a pivot-permutation index (operator 3).

Every vector is described by its nearest reference points (pivots) in order of
closeness. Inverted lists hold, for each pivot, the vectors that have it among their
``prefix`` nearest; two vectors that share at least ``shared`` pivots are candidates and
are verified by their cosine in double precision. Found links join vectors into
components; inside each component all pairs are then counted exactly, in blocks, so a
group of thousands of near copies emits one number a vector and no pair.

Pivots are a bounded sample (MAX_PIVOTS at most, in number growing with the square
root of the rows); every vector is indexed. Equal vectors are one class and compared
once.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are their own component; shorter vectors are compared as
if padded with zeros; repeated rows count as other vectors; rows with a null id take no
part and have a null component; columns beyond id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import written
from retentia.llm.graph import block_pairs, components, groups, spanning

THRESHOLD = 0.9
PREFIX, SHARED, MAX_PIVOTS = 10, 2, 4096
BLOCK_ROWS = 2048


def pivot_count(rows: int) -> int:
    return int(min(MAX_PIVOTS, max(16, round(3 * rows ** 0.5))))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vector.isNotNull() & F.coalesce(~bad, F.lit(False))
            & F.exists(vector, lambda x: x != 0))


def unit_rows(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as unit vectors in double precision."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes == width).all():
        rows = flat.reshape(-1, width)
    else:
        rows = np.zeros((len(sizes), width))
        rows[np.repeat(np.arange(len(sizes)), sizes),
             np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    # scaled first, so that squares neither overflow nor vanish
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def describe(classes: DataFrame, pivots: np.ndarray, prefix: int) -> DataFrame:
    """(rep, size, unit, pivots): unit vector as doubles' bytes, nearest pivots in order."""
    width, prefix = pivots.shape[1], min(prefix, len(pivots))
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = unit_rows(part.column(2), width)
                close = -(rows @ shared.value.T)
                first = np.argpartition(close, prefix - 1, axis=1)[:, :prefix]
                order = np.argsort(np.take_along_axis(close, first, 1), axis=1, kind="stable")
                near = np.take_along_axis(first, order, 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([r.tobytes() for r in rows], pa.binary()),
                     pa.array(near.tolist(), pa.list_(pa.int32()))],
                    names=["rep", "size", "unit", "pivots"])

    return (classes.select("rep", "size", "vector")
            .mapInArrow(run, "rep long, size long, unit binary, pivots array<int>"))


def _units(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def list_links(described: DataFrame, n_pivots: int, threshold: float, shared: int,
               block_rows: int) -> DataFrame:
    """(a, b) edges that span the verified links of every inverted list."""
    entries = described.select("rep", "unit", "pivots", F.explode("pivots").alias("pivot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groups(batches):
            if group.num_rows < 2:
                continue
            ids = group.column(4).to_numpy()
            unit = _units(group.column(5))
            near = group.column(6).combine_chunks()
            marks = np.zeros((len(ids), n_pivots), np.float32)
            marks[np.repeat(np.arange(len(ids)), np.diff(near.offsets.to_numpy())),
                  near.flatten().to_numpy()] = 1
            linked = (marks @ marks.T >= shared) & (unit @ unit.T >= threshold)
            edges = spanning(linked)
            if edges:
                a, b = np.array(edges).T
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])],
                                                 names=["a", "b"])

    dealt = block_pairs(entries, "pivot", F.xxhash64("rep"),
                        F.ceil(F.count(F.lit(1)) / block_rows), "pivot-lists",
                        ["rep", "unit", "pivots"])
    return dealt.mapInArrow(run, "a long, b long")


def count_links(members: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """(rep, linked): how many vectors of other classes each class links with. Members:
    rep, size, unit, component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for same, group in groups(batches):
            own, ids = group.column(3).to_numpy(), group.column(4).to_numpy()
            size, unit = group.column(5).to_numpy(), _units(group.column(6))
            linked = unit @ unit.T >= threshold
            if same:
                np.fill_diagonal(linked, False)
            else:
                linked &= own[:, None] != own[None, :]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(linked @ size)],
                                             names=["rep", "linked"])

    dealt = block_pairs(members, "component", F.xxhash64("rep"),
                        F.ceil(F.count(F.lit(1)) / block_rows), "vector-components",
                        ["rep", "size", "unit"])
    return (dealt.mapInArrow(run, "rep long, linked long")
            .groupBy("rep").agg(F.sum("linked").alias("linked")))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, prefix: int = PREFIX, shared: int = SHARED,
                    block_rows: int = BLOCK_ROWS, n_pivots: int | None = None) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).alias("vector"))
    rows = rows.withColumn("vector", F.when(F.col("vec_id").isNotNull() & usable(F.col("vector")),
                                            F.col("vector")))
    classes = written(rows.filter("vector IS NOT NULL").groupBy("vector")
                      .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size")),
                      "vector-classes")
    about = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                        F.col("vec_id").alias("component_id"),
                        F.col("vec_id").isNotNull().alias("kept"))
    if not about[0]:
        return alone
    n_pivots = n_pivots or pivot_count(about[0])
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(n_pivots).select("vector").collect()
    width = about[1]
    flat = pa.array([r["vector"] for r in sample], pa.list_(pa.float64()))
    described = written(describe(classes, unit_rows(flat, width), prefix), "vector-index")
    links = components(list_links(described, len(sample), threshold,
                                  min(shared, len(sample)), block_rows))
    found = written(links.withColumnRenamed("node", "rep"), "vector-links")
    members = described.join(found, "rep").select("rep", "size", "unit", "component")
    counted = count_links(members, threshold, block_rows)
    about_class = (classes.join(found, "rep", "left").join(counted, "rep", "left")
                   .select("vector", (F.col("size") - 1 + F.coalesce("linked", F.lit(0)))
                           .alias("_links"), F.coalesce("component", "rep").alias("_component")))
    return (rows.join(about_class, "vector", "left")
            .select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("_component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
