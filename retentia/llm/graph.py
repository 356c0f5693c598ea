"""Connected components of an edge table, and block pairs of large groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, component), the smallest node that a node reaches.

    Alternating star contraction: each round hangs every node's neighbours on its
    smallest neighbour, first the larger ones, then the smaller. Each step is a
    partial minimum and a join, so a node with very many edges is split like any skewed
    key; rounds grow with the logarithm of a component. Nodes without an edge are absent.
    """
    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .filter("u > v").distinct(), "edges")
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = (large.join(least, "u").filter("v > m")
                .select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = written(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        last, seen = seen, state(now)
        if seen == last:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select("component", "component").distinct()
                             .toDF("node", "component"))


def block_pairs(members: DataFrame, key: str, block: Column, blocks: Column, name: str,
                payload: list[str]) -> DataFrame:
    """Rows of each group dealt to pairs of its blocks: key, i, j, own, payload.

    ``blocks`` is an aggregate that says how many blocks a group needs, ``block`` a hash
    column that deals its rows to them. A group of one block is one pair (0, 0); of a
    larger one each row goes to the pairs of its block with every block, so no task holds
    more than two blocks. Rows come sorted by (key, i, j).
    """
    large = written(members.groupBy(key).agg(blocks.alias("_n")).filter("_n > 1"), name)
    dealt = (members.join(large, key, "left")
             .withColumn("_n", F.coalesce("_n", F.lit(1)).cast("int"))
             .withColumn("own", F.pmod(block, F.col("_n")).cast("int"))
             .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))))
    return (dealt.select(F.col(key).alias("key"), F.least("own", "_o").alias("i"),
                         F.greatest("own", "_o").alias("j"), "own", *payload)
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Table]]:
    """Whole groups of rows that come sorted by their first three columns; the flag says
    whether the group pairs a block with itself."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        change[0] = last is not None and tuple(k[0] for k in keys) != last
        cuts = np.flatnonzero(change).tolist()
        at = 0
        for cut in cuts:
            if cut > at:
                held.append(batch.slice(at, cut - at))
            yield _whole(held)
            held, at = [], cut
        held.append(batch.slice(at))
        last = tuple(k[-1] for k in keys)
    if held:
        yield _whole(held)


def _whole(held: list[pa.RecordBatch]) -> tuple[bool, pa.Table]:
    table = pa.Table.from_batches(held)
    return table.column(1)[0] == table.column(2)[0], table


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    n = len(linked)
    free = np.ones(n, bool)
    edges = []
    for root in range(n):
        if not free[root]:
            continue
        free[root] = False
        front = [root]
        while front:
            u = front.pop()
            new = np.flatnonzero(linked[u] & free)
            free[new] = False
            edges.extend((u, int(v)) for v in new)
            front.extend(new.tolist())
    return edges
