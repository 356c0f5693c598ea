"""Exact top-k inner products by a bit-sliced index (operator 6).

Vectors become integers, floor(256 * x) in each component. A block of rows is indexed as
bit slices: for each component and each bit above the lowest ``drop`` one bitmap over
the block's rows. For a query the slices are added with bitmap arithmetic (carry-save
adders over whole bitmaps, a slice entering once for each set bit of the query's
component, complemented where that is negative), which gives the bits of all rows' sums.
The k-th greatest sum is read from the most significant slice downward; rows that the
dropped bits could still lift over it are the boundary, and are resolved exactly from
their integers.

Queries meet the index in blocks: a block of rows and a part of the queries make one
group, each emits at most k rows a query, and these are ranked per query.

Integers that 64-bit sums could not hold (from 2**28 on at 64 dimensions) do not go into slices: such a
vector is kept as doubles, meets the same blocks, and its scores are whole numbers of any size.

Defined results: rows with a null id, a null vector, or null or non-finite components take no part;
shorter vectors count as
padded with zeros; repeated rows are separate candidates, of a repeated query id the row
with the smallest vector asks; ties go to the smaller id; fewer candidates than k give all; a score
beyond long is given as the nearest long, and ranked by its own size; an
empty table gives no rows; columns beyond id and vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
BLOCK_ROWS, PART_QUERIES, DROP_BITS = 8192, 2048, 2
_LONG = (1 << 63) - 1


def taking_part(vector: Column) -> Column:
    """The components as doubles, null if one is null or not finite."""
    whole = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.when(whole, F.transform(vector, lambda x: x.cast("double")))


def limit(width: int) -> int:
    """Integers below this in size have inner products below 2**62."""
    return 1 << (62 - max(1, width - 1).bit_length()) // 2


def quantised(vector: Column, below: int) -> Column:
    """floor(SCALE * x) of each component, null unless all are smaller than ``below``."""
    scaled = F.transform(vector, lambda x: x * SCALE)
    return F.when(F.forall(scaled, lambda x: F.abs(x) < below - 1),
                  F.transform(scaled, lambda x: F.floor(x).cast("long")))


def whole_numbers(vector: list[float]) -> list[int]:
    """floor(SCALE * x) without a bound. A double times a power of two is exact."""
    return [math.floor(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE for x in vector]


def sortable(score: int) -> str | None:
    """Text that sorts as the score among scores that long cannot hold, null for others."""
    if abs(score) < _LONG:
        return None
    digits = str(abs(score))
    if score < 0:
        return f"0{9999 - len(digits):04d}" + "".join(str(9 - int(d)) for d in digits)
    return f"1{len(digits):04d}{digits}"


class BitSlicedBlock:
    """The slices of one block of rows; ids ascend."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, drop: int = DROP_BITS) -> None:
        self.ids, self.values, self.drop = ids, values, drop
        self.low = values.min(axis=0)
        coarse = (values - self.low) >> drop
        self.bits = [int(m).bit_length() for m in coarse.max(axis=0)]
        self.all = (1 << len(ids)) - 1
        self.slices = [
            [int.from_bytes(np.packbits((coarse[:, d] >> j & 1).astype(np.uint8),
                                        bitorder="little").tobytes(), "little")
             for j in range(n)] for d, n in enumerate(self.bits)]

    def sums(self, query: list[int]) -> list[int]:
        """Slices of sum(|q| * (coarse or its complement)), least significant first."""
        piles: list[list[int]] = [[]]
        for q, slices in zip(query, self.slices, strict=True):
            if not q:
                continue
            turned = slices if q > 0 else [self.all ^ s for s in slices]
            size, shift = abs(q), 0
            while size:
                if size & 1:
                    while len(piles) < shift + len(turned):
                        piles.append([])
                    for j, s in enumerate(turned):
                        piles[shift + j].append(s)
                size >>= 1
                shift += 1
        made = []
        at = 0
        while at < len(piles):
            pile = piles[at]
            if len(pile) > 1 and at + 1 == len(piles):
                piles.append([])
            while len(pile) > 2:
                a, b, c = pile.pop(), pile.pop(), pile.pop()
                half = a ^ b
                pile.append(half ^ c)
                piles[at + 1].append((a & b) | (half & c))
            if len(pile) == 2:
                a, b = pile
                made.append(a ^ b)
                piles[at + 1].append(a & b)
            else:
                made.append(pile[0] if pile else 0)
            at += 1
        return made

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows but the query's own, best first."""
        rows = self.all
        for r in range(*np.searchsorted(self.ids, [query_id, query_id + 1]).tolist()):
            rows ^= 1 << r
        if rows.bit_count() > k:
            asked = query.tolist()
            sums = self.sums(asked)
            # the k-th greatest sum, from the most significant slice downward
            left, some, bound = k, rows, 0
            for i in range(len(sums) - 1, -1, -1):
                hit = some & sums[i]
                n = hit.bit_count()
                if n >= left:
                    some, bound = hit, bound | 1 << i
                else:
                    left, some = left - n, some ^ hit
            # what the dropped bits of all components can make up for
            slack = sum(map(abs, asked)) * ((1 << self.drop) - 1)
            bound = max(0, bound - (-(-slack // (1 << self.drop))))
            above, equal = 0, rows
            for i in range(max(len(sums), bound.bit_length()) - 1, -1, -1):
                s = sums[i] if i < len(sums) else 0
                if bound >> i & 1:
                    equal &= s
                else:
                    above |= equal & s
                    equal ^= equal & s
            rows = above | equal
        packed = np.frombuffer(rows.to_bytes(-(-len(self.ids) // 8), "little"), np.uint8)
        at = np.flatnonzero(np.unpackbits(packed, count=len(self.ids), bitorder="little"))
        scores = self.values[at] @ query
        best = np.lexsort((self.ids[at], -scores))[:k]
        return self.ids[at][best], scores[best]


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    rows = np.zeros((len(sizes), width), np.int64)
    rows[np.repeat(np.arange(len(sizes)), sizes),
         np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return rows


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = BLOCK_ROWS,
          part_queries: int = PART_QUERIES, drop_bits: int = DROP_BITS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every query. ``is_query`` is a
    condition on the id column."""
    taking = (vectors.select(F.col(id_col).cast("long").alias("id"), is_query.alias("asks"),
                             taking_part(F.col(vector_col)).alias("x")).filter("id IS NOT NULL AND x IS NOT NULL"))
    n, n_queries, width = taking.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("x"))).first()
    rows = (taking.withColumn("q", quantised(F.col("x"), limit(width or 1)))
            .withColumn("x", F.when(F.col("q").isNull(), F.col("x"))))
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-n_queries // part_queries))

    def dealt(count: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    smallest = F.min(F.struct(F.coalesce("x", F.transform("q", lambda v: v / SCALE)).alias("by"), "q", "x"))
    queries = rows.filter("asks").groupBy("id").agg(smallest.alias("v")).select("id", "v.q", "v.x")
    index = rows.select(dealt(blocks).alias("block"), each(parts).alias("part"),
                        F.lit(0).alias("kind"), "id", "q", "x")
    asked = queries.select(each(blocks).alias("block"), dealt(parts).alias("part"),
                           F.lit(1).alias("kind"), "id", "q", "x")
    met = (index.unionByName(asked).repartition("block", "part")
           .sortWithinPartitions("block", "part", "kind", "id"))

    def merged(query_id: int, query: list[int], block, wide: list, near: tuple) -> tuple:
        """The k best of ``near`` and the wide rows, by whole numbers; for a wide query, whose
        ``near`` is None, of all rows."""
        found = [] if near is None else [(-int(s), int(i)) for i, s in zip(*near, strict=True)]
        if near is None and block is not None:
            asked = np.array(query, object)
            scores = block.values[:, :len(query)].astype(object) @ asked
            found += [(-s, i) for i, s in zip(block.ids.tolist(), scores.tolist(), strict=True) if i != query_id]
        found += [(-sum(a * b for a, b in zip(query, v, strict=False)), i) for i, v in wide if i != query_id]
        best = sorted(found)[:k]
        return [i for _, i in best], [-s for s, _ in best]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, values, wide, block = None, [], [], [], None
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in range(4)]
            matrix = _matrix(batch.column(4), width or 0)
            large = batch.column(5).is_valid().to_numpy(zero_copy_only=False)
            found: list[tuple] = []
            change = np.flatnonzero(np.diff(keys[0]) | np.diff(keys[1]) | np.diff(keys[2])) + 1
            for a, b in zip([0, *change], [*change, batch.num_rows], strict=True):
                if a == b:
                    continue
                if at != (keys[0][a], keys[1][a]):
                    at, ids, values, wide, block = (keys[0][a], keys[1][a]), [], [], [], None
                if keys[2][a] == 0:
                    plain = a + np.flatnonzero(~large[a:b])
                    ids.append(keys[3][plain])
                    values.append(matrix[plain])
                    wide += [(int(keys[3][r]), whole_numbers(batch.column(5)[r].as_py()))
                             for r in (a + np.flatnonzero(large[a:b])).tolist()]
                    continue
                if block is None and sum(map(len, ids)):
                    block = BitSlicedBlock(np.concatenate(ids), np.concatenate(values), drop_bits)
                    ids, values = [], []
                for r in range(a, b):
                    query_id = int(keys[3][r])
                    if large[r]:
                        query, near = whole_numbers(batch.column(5)[r].as_py()), None
                    else:
                        query, near = matrix[r], ([], [])
                        if block is not None:
                            near = block.top(query_id, query, k)
                    if wide or large[r]:
                        near = merged(query_id, list(map(int, query)), block, wide, near)
                    found.append((query_id, *near))
            if found:
                best = [i for _, rows, _ in found for i in rows]
                scores = [int(s) for _, _, some in found for s in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q for q, rows, _ in found for _ in rows], pa.int64()), pa.array(best, pa.int64()),
                     pa.array([max(-_LONG, min(_LONG, s)) for s in scores], pa.int64()),
                     pa.array([sortable(s) for s in scores], pa.string())],
                    names=["query_id", "vec_id", "score", "beyond"])

    best = met.mapInArrow(run, "query_id long, vec_id long, score long, beyond string")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(
        F.desc("score"), F.desc_nulls_last("beyond"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
