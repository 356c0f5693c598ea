"""Merkle manifest of a dataset by bitmap-rank indexing (operator 13).

Every row is a leaf, the hash of its fields; the leaves of a group (a language) ascend by id
and FANOUT consecutive nodes become one until one is left, the group's subroot; the subroots,
in the order of the groups, become the root in the same way.

A leaf's coordinate is a rank, and no leaf is sorted for it. Tasks turn the ids they read into
compressed bitmaps, one for each group and each run of 65,536 ids (a sorted list of 16-bit
places, or a bitmap where that is shorter, and the counts of ids that repeat). The bitmaps of a
run are merged; their popcounts, summed over runs and over spans of SPAN runs, are the directory.
A leaf meets its run's bitmap, and its slot is the directory's count before the run plus the
popcount below its place. Slots key the rest: BLOCK = FANOUT ** BLOCK_LEVELS consecutive slots
make one array, which is filled by slot and reduced BLOCK_LEVELS levels at a time; the nodes that are
left are slots of the next round. Paths to the root come down the same arrays. A group with
most of the rows is as many arrays as it needs, and no task holds more than one.

Defined results: null fields hash as ``-``, so null texts, sources and ids are leaves like
others; a null group is a group of its own and comes first; null ids come before all others;
rows that repeat an id are leaves each, ordered by their hash, and rows repeated whole are
leaves with equal hashes; empty and very long texts are hashed whole; an empty table has no
leaves and gives no rows; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.llm.common import written
from retentia.llm.graph import groups

FANOUT, BLOCK_LEVELS = 8, 4
BLOCK = FANOUT ** BLOCK_LEVELS
RUN_BITS, SPAN_BITS = 16, 10
RUN = 1 << RUN_BITS
# The run of null ids, before that of the smallest one.
_NULL_RUN = -(1 << (63 - RUN_BITS)) - 1

_HEAD = struct.Struct("<?II")
_LEVELS = "array<struct<before:string,after:string>>"
_LEVEL_TYPE = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


# ---- leaves ----------------------------------------------------------------------


def field(column: Column) -> Column:
    """The UTF-8 length, a colon and the value; ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


# ---- bitmaps ---------------------------------------------------------------------


def packed_run(places: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending places in a run, with how often each occurs, in the shorter of two forms."""
    again = np.flatnonzero(counts > 1)
    dense = 2 * len(places) > RUN // 8
    if dense:
        marks = np.zeros(RUN, np.uint8)
        marks[places] = 1
        body = np.packbits(marks, bitorder="little").tobytes()
    else:
        body = places.astype("<u2").tobytes()
    return b"".join([_HEAD.pack(dense, len(places), len(again)), body,
                     places[again].astype("<u2").tobytes(), counts[again].astype("<i8").tobytes()])


def unpacked_run(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    dense, n, n_again = _HEAD.unpack_from(data)
    at = _HEAD.size
    if dense:
        marks = np.unpackbits(np.frombuffer(data, np.uint8, RUN // 8, at), bitorder="little")
        places = np.flatnonzero(marks)
        at += RUN // 8
    else:
        places = np.frombuffer(data, "<u2", n, at).astype(np.int64)
        at += 2 * n
    counts = np.ones(len(places), np.int64)
    again = np.frombuffer(data, "<u2", n_again, at)
    counts[np.searchsorted(places, again)] = np.frombuffer(data, "<i8", n_again, at + 2 * n_again)
    return places, counts


def _task_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
        found, counts = np.unique(keys, axis=1, return_counts=True)
        cuts = np.flatnonzero((np.diff(found[:2]) != 0).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), found.shape[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found[0, edges[:-1]]), pa.array(found[1, edges[:-1]]),
             pa.array([packed_run(found[2, a:b], counts[a:b])
                       for a, b in zip(edges, edges[1:], strict=False)], pa.binary())],
            names=["g", "run", "bits"])


def _merged_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, same in groups(batches):
        total = np.zeros(RUN, np.int64)
        for data in same.column(3).to_pylist():
            places, counts = unpacked_run(data)
            total[places] += counts
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [same.column(0)[:1].combine_chunks(), same.column(1)[:1].combine_chunks(),
             pa.array([packed_run(places, total[places])], pa.binary()),
             pa.array([int(total.sum())], pa.int64())], names=["g", "run", "bits", "n"])


def bitmaps(keyed: DataFrame) -> DataFrame:
    """(g, run, place) rows -> (g, run, bits, n): one merged bitmap for each run of ids."""
    parts = (keyed.select("g", "run", "place")
             .mapInArrow(_task_bitmaps, "g long, run long, bits binary"))
    return (parts.select("g", "run", F.lit(0).alias("_0"), "bits").repartition("g", "run")
            .sortWithinPartitions("g", "run")
            .mapInArrow(_merged_bitmaps, "g long, run long, bits binary, n long"))


def directory(runs: DataFrame) -> DataFrame:
    """(g, run, n) -> (g, run, before): rows of the group in the runs before."""
    def below(*keys):
        return (Window.partitionBy(*keys[:-1]).orderBy(keys[-1])
                .rowsBetween(Window.unboundedPreceding, -1))

    spanned = runs.select("g", F.shiftright("run", SPAN_BITS).alias("span"), "run", "n")
    spans = (spanned.groupBy("g", "span").agg(F.sum("n").alias("n"))
             .select("g", "span", F.coalesce(F.sum("n").over(below("g", "span")), F.lit(0)).alias("s")))
    own = F.coalesce(F.sum("n").over(below("g", "span", "run")), F.lit(0))
    return (spanned.withColumn("o", own).join(spans, ["g", "span"])
            .select("g", "run", (F.col("s") + F.col("o")).alias("before")))


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams of a run's bitmap (kind 0) and its rows (kind 1): adds slot and copies."""
    at, start, counts = None, None, None
    for batch in batches:
        kinds = batch.column(2).to_numpy()
        gs, runs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        places = batch.column(3).to_numpy(zero_copy_only=False)
        slots, copies = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        change = np.flatnonzero(np.diff(gs) | np.diff(runs) | np.diff(kinds)) + 1
        for a, b in zip([0, *change], [*change, batch.num_rows], strict=True):
            if a == b:
                continue
            if kinds[a] == 0:
                at = (gs[a], runs[a])
                found, n = unpacked_run(batch.column(5)[int(a)].as_py())
                counts = np.zeros(RUN, np.int64)
                counts[found] = n
                start = np.cumsum(counts) - counts + batch.column(4)[int(a)].as_py()
                continue
            if at != (gs[a], runs[a]):
                raise ValueError("rows of a run without a bitmap")
            slots[a:b] = start[places[a:b]]
            copies[a:b] = counts[places[a:b]]
        rows = np.flatnonzero(kinds == 1)
        if len(rows):
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), pa.array(slots[rows]), pa.array(copies[rows]), taken.column(6),
                 taken.column(7), taken.column(8)],
                names=["g", "slot", "copies", "id", "leaf", "altered"])


def slots(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``leaves``: g, id, leaf, altered. -> (g, slot, id, leaf, altered), from 0 in each group by
    id, and (g, size)."""
    run = F.coalesce(F.shiftright("id", RUN_BITS), F.lit(_NULL_RUN))
    place = F.coalesce(F.col("id").bitwiseAND(RUN - 1), F.lit(0))
    keyed = leaves.withColumns({"run": run, "place": place})
    runs = written(bitmaps(keyed), "merkle-bitmaps")
    nothing = F.lit(None)
    index = runs.join(directory(runs.select("g", "run", "n")), ["g", "run"]).select(
        "g", "run", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("place"), "before", "bits",
        nothing.cast("long").alias("id"), nothing.cast("binary").alias("leaf"),
        nothing.cast("binary").alias("altered"))
    rows = keyed.select("g", "run", F.lit(1).alias("kind"), "place", nothing.cast("long").alias("before"),
                        nothing.cast("binary").alias("bits"), "id", "leaf", "altered")
    ranked = written(
        index.unionByName(rows).repartition("g", "run").sortWithinPartitions("g", "run", "kind")
        .mapInArrow(_ranked, "g long, slot long, copies long, id long, leaf binary, altered binary"),
        "merkle-slots")
    # rows of one id follow each other by hash: counted by its first byte, then within it
    twice = ranked.filter("copies > 1").withColumn("byte", F.substring("leaf", 1, 1))
    first = (twice.groupBy("g", "slot", "byte").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("shift", F.coalesce(F.sum("n").over(
                 Window.partitionBy("g", "slot").orderBy("byte")
                 .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n"))
    order = Window.partitionBy("g", "slot", "byte").orderBy("leaf", "altered")
    placed = (twice.withColumn("at", F.row_number().over(order) - 1)
              .join(first, ["g", "slot", "byte"])
              .select("g", (F.col("slot") + F.col("shift") + F.col("at")).alias("slot"), "id", "leaf",
                      "altered"))
    alone = ranked.filter("copies = 1").select("g", "slot", "id", "leaf", "altered")
    sizes = written(runs.groupBy("g").agg(F.sum("n").alias("size")), "merkle-sizes")
    return alone.unionByName(placed), sizes


# ---- levels ----------------------------------------------------------------------


def levels_of(size: int) -> int:
    """How often FANOUT nodes become one until one of ``size`` is left."""
    n = 0
    while size > 1:
        size, n = -(-size // FANOUT), n + 1
    return n


def parents(hashes: list[str]) -> list[str]:
    return [sha256("".join(hashes[i:i + FANOUT]).encode()).hexdigest()
            for i in range(0, len(hashes), FANOUT)]


def _hexes(data: bytes) -> list[str]:
    text = data.hex()
    return [text[i:i + 64] for i in range(0, len(text), 64)]


def _filled(same: pa.Table, column: int, first: int) -> list:
    """The values of a keyed array in order of its slots."""
    made: list = [None] * same.num_rows
    for at, value in zip(same.column(3).to_pylist(), same.column(column).to_pylist(), strict=True):
        made[at - first] = value
    return made


def arrays(nodes: DataFrame, sizes: DataFrame, more: list[str]) -> DataFrame:
    """``nodes``: g, slot, hash and columns of ``more`` -> one row for each BLOCK of slots: g, block, depth
    (levels to reduce it), size of the group, nodes (all hashes), top (hash of the block), and
    each of ``more`` as an array."""
    keyed = (nodes.join(sizes, "g")
             .withColumn("block", F.expr(f"slot div {BLOCK}")))
    kinds = {f.name: f.dataType for f in nodes.schema}
    arrow = {"long": pa.int64(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, same in groups(batches):
            g, block, size = (same.column(i)[0].as_py() for i in (0, 1, 4))
            depth = min(BLOCK_LEVELS, levels_of(size))
            hashes = _filled(same, 5, block * BLOCK)
            up = [h.hex() for h in hashes]
            for _ in range(depth):
                up = parents(up)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g], pa.int64()), pa.array([block], pa.int64()), pa.array([depth], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([b"".join(hashes)], pa.binary()),
                 pa.array([bytes.fromhex(up[0])], pa.binary()),
                 *[pa.array([_filled(same, 6 + i, block * BLOCK)], pa.list_(arrow[kinds[c].simpleString()]))
                   for i, c in enumerate(more)]],
                names=["g", "block", "depth", "size", "nodes", "top", *more])

    listed = "".join(f", {c} array<{kinds[c].simpleString()}>" for c in more)
    return (keyed.select("g", "block", F.lit(0).alias("_0"), "slot", "size", "hash", *more)
            .repartition("g", "block").sortWithinPartitions("g", "block")
            .mapInArrow(run, "g long, block long, depth long, size long, nodes binary, top binary" + listed))


def block_paths(nodes: bytes, depth: int) -> list[list[dict]]:
    """For every node of an array the siblings before and after it on each of its levels."""
    level = _hexes(nodes)
    rows = []
    for _ in range(depth):
        made = []
        for i in range(len(level)):
            a = i - i % FANOUT
            made.append({"before": "".join(level[a:i]), "after": "".join(level[i + 1:a + FANOUT])})
        rows.append(made)
        level = parents(level)
    return [[rows[k][i // FANOUT ** k] for k in range(depth)] for i in range(len(_hexes(nodes)))]


def _lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays with the path above them -> each node's whole path: g, slot, path."""
    for batch in batches:
        for at in range(batch.num_rows):
            g, block, depth, nodes, above = (c[at].as_py() for c in batch.columns)
            paths = [own + above for own in block_paths(nodes, depth)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * len(paths), pa.int64()),
                 pa.array([block * BLOCK + i for i in range(len(paths))], pa.int64()),
                 pa.array(paths, _LEVEL_TYPE)], names=["g", "slot", "path"])


def _leaf_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            nodes, depth, ids, altered, above, subroot, root = (c[row].as_py() for c in batch.columns)
            hashes, paths = _hexes(nodes), block_paths(nodes, depth)
            for at in range(0, len(ids), 512):
                part = slice(at, at + 512)
                n = len(ids[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[part], pa.int64()), pa.array(hashes[part]),
                     pa.array([a and a.hex() for a in altered[part]], pa.string()),
                     pa.array([subroot] * n), pa.array([root] * n),
                     pa.array([own + above for own in paths[part]], _LEVEL_TYPE)],
                    names=["id", "leaf", "altered", "subroot", "root", "proof"])


def tree(nodes: DataFrame, sizes: DataFrame, more: list[str], name: str
         ) -> tuple[list[DataFrame], DataFrame]:
    """The written arrays of all rounds, and (g, top): the last hash of each group."""
    most = sizes.agg(F.max("size")).first()[0] or 0
    rounds, tops, size = [], None, F.col("size")
    while True:
        made = written(arrays(nodes, sizes, more), name)
        rounds.append(made)
        done = made.filter(size <= BLOCK).select("g", "top")
        tops = done if tops is None else tops.unionByName(done)
        if most <= BLOCK:
            return rounds, tops
        most, more = -(-most // BLOCK), []
        above = made.filter(size > BLOCK)
        nodes = above.select("g", F.col("block").alias("slot"), F.col("top").alias("hash"))
        sizes = above.groupBy("g").agg(F.count(F.lit(1)).alias("size"))


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def siblings(proof: Column) -> Column:
    """All sibling hashes of a proof in one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def manifest(docs: DataFrame, altered: Column, group_col: str = "lang", id_col: str = "doc_id",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, leaf, altered (the leaf with the column ``altered`` in
    place of the text, null where that is null), subroot, root, and proof: the siblings before
    and after it on each level up to the root, as hex text."""
    def column(c):
        return F.col(f"`{c}`")

    other = leaf(*[altered if c == text_col else column(c) for c in fields])
    hashed = written(docs.select(
        column(group_col).alias("group"), column(id_col).cast("long").alias("id"),
        F.unhex(leaf(*[column(c) for c in fields])).alias("leaf"),
        F.when(altered.isNotNull(), F.unhex(other)).alias("altered")), "merkle-leaves")
    # the groups are few (languages); their number is their place, null first, by bytes
    named = written(hashed.select("group").distinct().withColumn(
        "g", F.row_number().over(Window.orderBy(F.asc_nulls_first("group"))).cast("long") - 1), "merkle-groups")
    numbered = hashed.join(named, hashed["group"].eqNullSafe(named["group"]), "inner").select(
        "g", "id", "leaf", "altered")
    placed, sizes = slots(numbered)
    rounds, tops = tree(placed.withColumnRenamed("leaf", "hash"), sizes, ["id", "altered"], "merkle-arrays")
    subroots = written(tops, "merkle-subroots")
    heads, root = tree(
        subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("slot"), F.col("top").alias("hash")),
        subroots.select(F.lit(0).cast("long").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("size")),
        [], "merkle-heads")
    none = F.array().cast(_LEVELS)
    # paths come down: first over the groups, then over the rounds of their arrays
    above = None
    for made in reversed(heads):
        path = none if above is None else F.col("path")
        rows = made if above is None else made.join(
            above.withColumnRenamed("slot", "block"), ["g", "block"])
        above = written(rows.select("g", "block", "depth", "nodes", path.alias("path"))
                        .mapInArrow(_lowered, f"g long, slot long, path {_LEVELS}"), "merkle-paths")
    over = above.select(F.col("slot").alias("g"), F.col("path").alias("over"))
    lower = None
    for i, made in reversed(list(enumerate(rounds))):
        rows = made.join(over, "g")
        if lower is not None:
            rows = rows.join(lower.withColumnRenamed("slot", "block"), ["g", "block"], "left")
            rows = rows.withColumn("path", F.coalesce("path", "over"))
        else:
            rows = rows.withColumn("path", F.col("over"))
        if i:
            lower = written(rows.select("g", "block", "depth", "nodes", "path")
                            .mapInArrow(_lowered, f"g long, slot long, path {_LEVELS}"), "merkle-paths")
    named_tops = subroots.select("g", F.lower(F.hex("top")).alias("subroot"))
    final = root.first()  # one row, none for an empty table
    return (rows.join(named_tops, "g")
            .select("nodes", "depth", "id", "altered", "path", "subroot",
                    F.lit(final["top"].hex() if final else "").alias("root"))
            .mapInArrow(_leaf_rows, "id long, leaf string, altered string, subroot string, root string, "
                                    f"proof {_LEVELS}"))
