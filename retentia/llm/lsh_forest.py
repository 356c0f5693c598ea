"""N-gram Jaccard join by a MinHash LSH forest (operator 4).

A text's five-word shingles (lower case, words between white space) get a MinHash
signature of TREES x DEPTH values. Each tree is a prefix trie over its DEPTH values in
order: texts under one node share a prefix. Texts under one node are compared by their
signatures; pairs that may reach the threshold connect texts into families.

The first round takes the longest prefix with which a pair at the threshold meets in some tree
with the target recall. A text that has found a partner then is at the target; each text without one
is passed on to the next shorter prefix, where it meets all texts, until a pair at the threshold
would have been missed with a chance below MISSED (5e-8 at the fourth value).

Large groups of near copies are met once, not under each of their nodes. The first round begins
with FIRST_TREES trees, whose large nodes are compared in blocks that share one text. Families of
BIG texts or more that this connects leave the forest as texts and stay as classes: another
text or class that shares a node with such a class is compared with its members once,
whatever the number of nodes they share.

Families are then verified exactly, by shingle sets: all pairs inside a family, in
blocks, so that every link is counted and a family of thousands of near copies emits
one number a text and a spanning forest, never its pairs. Equal texts are one class.

Defined results: null text is empty; a text without words links with nothing; one of
fewer words than a shingle is one shingle of all its words; very long texts are read whole;
repeated rows count as other documents, and so do different texts under one id; rows with a null
id take no part and have a null component; an empty table has no rows; columns beyond id and
text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import distilled, text_of, written
from retentia.llm.graph import block_pairs, components, groups, spanning

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, TARGET_RECALL = 32, 8, 0.999
# Pairs whose signatures agree in less than this share are not a family: four standard
# errors of the estimate below the threshold.
SLACK = 4.0
BLOCK_ROWS, BLOCK_CHARS = 1500, 4_000_000
# Isolated texts go on to shorter prefixes until a pair at the threshold is missed with this chance.
MISSED = 1e-6
# Trees of the first pass, texts of its blocks, and texts that make a family a class of its own.
FIRST_TREES, FIRST_ROWS, BIG = 8, 256, 256

_RANDOM = np.random.default_rng(20240611)
_PLACES = _RANDOM.integers(1, 1 << 62, 64, dtype=np.uint64) | np.uint64(1)
_FACTORS = _RANDOM.integers(1, 1 << 62, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RANDOM.integers(0, 1 << 62, TREES * DEPTH, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def recall(similarity: float, depth: int, trees: int = TREES) -> float:
    """Chance that a pair of this similarity shares a prefix of this depth in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def matched_depth(threshold: float, target: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix with which a pair at the threshold meets with the target recall."""
    while depth > 1 and recall(threshold, depth, trees) < target:
        depth -= 1
    return depth


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _STEP
    return x ^ (x >> np.uint64(29))


def shingles(text: str, n_words: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of the text's shingles, ascending."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.frombuffer(" ".join(words).encode("utf-32-le", "replace"), np.uint32)
    ends = np.append(np.flatnonzero(codes == 32), len(codes))
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
    # a word's hash: its code points times constants of their places, longer words in laps
    value = (codes.astype(np.uint64) + _STEP * (place >> 6).astype(np.uint64)) * _PLACES[place & 63]
    value[codes == 32] = 0
    word = _mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64))
    n = min(n_words, len(word))
    made = np.zeros(len(word) - n + 1, np.uint64)
    for i in range(n):
        made = _mix(made * np.uint64(3) + word[i:len(word) - n + 1 + i])
    return np.unique(made)


def signature(found: np.ndarray) -> bytes:
    """TREES x DEPTH MinHash values, tree by tree: 48 bits of a tree's first value, so that
    chance meetings at its first values stay rare in large corpora, and 8 of each other."""
    low = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        hashed = np.multiply.outer(_FACTORS, found[at:at + 2048]) + _TERMS[:, None]
        np.minimum(low, hashed.min(axis=1), out=low)
    values = low.reshape(TREES, DEPTH)
    shifts = np.arange(56, 8, -8, dtype=np.uint64)
    parts = [values[:, :1] >> shifts, values[:, 1:] >> np.uint64(16)]
    return (np.hstack(parts) & np.uint64(0xFF)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, n_words: int = WORDS) -> DataFrame:
    """(doc_id, text) -> (doc_id, cls, sig): the class of equal texts, null sig without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [shingles(t, n_words) for t in part.column(2).to_pylist()]
                made = [signature(f) if len(f) else None for f in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(made, pa.binary())],
                    names=["doc_id", "cls", "sig"])

    return (docs.select("doc_id", F.md5("text").alias("cls"), "text")
            .mapInArrow(run, "doc_id long, cls string, sig binary"))


def _bytes(depth: int) -> int:
    """Length of a prefix of this depth."""
    return depth + 5


def low_bytes(sig: Column) -> Column:
    """Eight bits of every value of a signature."""
    return F.concat(*[F.substring(sig, t * _bytes(DEPTH) + 6, DEPTH) for t in range(TREES)])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The values of ``low_bytes``, a row for each signature."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def forest(reps: DataFrame, shortest: int) -> DataFrame:
    """(rep, tree, path) rows of the texts that share a node of depth ``shortest`` in the tree."""
    places = F.sequence(F.lit(0), F.lit(TREES - 1))

    def path(tree: Column, depth: int) -> Column:
        return F.call_function("substring", F.col("sig"), tree * _bytes(DEPTH) + 1, F.lit(_bytes(depth)))

    labels = reps.select("rep", F.posexplode(F.transform(
        places, lambda t: F.xxhash64(t, path(t, shortest)))).alias("tree", "node"))
    shared = written(labels.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                     .select("node"), "forest-nodes")
    # nodes, members and families grow with the corpus: the same joins at every size
    rows = labels.join(shared.hint("merge"), "node", "left_semi").select("rep", "tree")
    return written(rows.join(reps.hint("merge"), "rep")
                   .select("rep", "tree", path(F.col("tree"), DEPTH).alias("path")), "forest")


def _level(rows: DataFrame, depth: int) -> DataFrame:
    """The node of a depth that each forest row lies under."""
    prefix = F.call_function("substring", F.col("path"), F.lit(1), F.lit(_bytes(depth)))
    return rows.withColumn("node", F.xxhash64("tree", prefix)).drop("path", "tree")


def _nodes(level: DataFrame) -> DataFrame:
    """(node, n, lead) of the nodes with an asking text and another; of those with the same members
    in several trees one. ``level``: rep, node, asks."""
    return (level.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.max("asks").alias("asked"),
        F.min("rep").alias("lead"))
        .filter("n > 1 AND asked").groupBy("n", "x", "lead").agg(F.min("node").alias("node"))
        .select("node", "n", "lead"))


def first_families(level: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """(a, b) edges under the nodes of some trees. A node of more than FIRST_ROWS texts is compared in
    blocks, each of which holds its first text."""
    nodes = written(_nodes(level.withColumn("asks", F.lit(True))), "first-nodes")
    blocks = F.ceil(F.col("n") / FIRST_ROWS).cast("int")
    own = F.array(F.pmod(F.xxhash64("rep", "node"), blocks).cast("int"))
    every = F.sequence(F.lit(0), blocks - 1)
    dealt = (level.join(nodes.hint("merge"), "node")
             .select("node", F.explode(F.when(F.col("rep") == F.col("lead"), every).otherwise(own)).alias("i"),
                     "rep").join(sigs.hint("merge"), "rep")
             .select("node", "i", F.col("i").alias("j"), "i", "rep", F.lit(True).alias("asks"), "low"))
    return _compared(dealt.toDF("key", "i", "j", "own", "rep", "asks", "low")
                     .repartition("key", "i").sortWithinPartitions("key", "i"), least)


def text_pairs(level: DataFrame, sigs: DataFrame, least: float, block_rows: int) -> DataFrame:
    """(a, b) edges that span the pairs under each node of which a text at least asks."""
    nodes = written(_nodes(level), "trie-nodes")
    members = (level.join(nodes.select("node").hint("merge"), "node").join(sigs.hint("merge"), "rep"))
    return _compared(block_pairs(members, "node", F.xxhash64("rep"), F.ceil(F.count(F.lit(1)) / block_rows),
                                 "large-nodes", ["rep", "asks", "low"]), least)


def _compared(dealt: DataFrame, least: float) -> DataFrame:
    """(a, b) edges inside the groups of ``dealt``: key, i, j, own, rep, asks, low."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groups(batches):
            asks = group.column(5).to_numpy()
            if group.num_rows < 2 or not asks.any():
                continue
            ids, sig = group.column(4).to_numpy(), _matrix(group.column(6))
            linked = agreeing(sig, np.flatnonzero(asks), least)
            edges = spanning(linked | linked.T)
            if edges:
                a, b = np.array(edges).T
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])],
                                                 names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def class_pairs(asked: DataFrame, settled: DataFrame, sigs: DataFrame, least: float, block_rows: int
                ) -> DataFrame:
    """(a, b) edges from texts to a member of the class that each is compared with. ``asked``: rep,
    family; ``settled``: rep, family."""
    def sized(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))

    sizes = written(sized(asked, "n_asks").join(sized(settled, "n_members"), "family"), "class-sizes")

    def dealt(rows: DataFrame, own: str, others: str, asks: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("rep"), F.col(f"n_{own}")).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.col(f"n_{others}") - 1))
        made = rows.join(sizes, "family").select("family", "rep", block.alias("_own"), each.alias("_other"))
        i, j = ("_own", "_other") if asks else ("_other", "_own")
        return (made.join(sigs.hint("merge"), "rep")
                .select("family", F.col(i).alias("i"), F.col(j).alias("j"), F.lit(asks).alias("asks"), "rep", "low"))

    both = dealt(asked, "asks", "members", True).unionByName(dealt(settled, "members", "asks", False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groups(batches):
            asks, ids, sig = (group.column(3).to_numpy(), group.column(4).to_numpy(), _matrix(group.column(5)))
            mine, others = np.flatnonzero(asks), np.flatnonzero(~asks)
            if not len(mine) or not len(others):
                continue
            columns = np.ascontiguousarray(sig[others].T)
            found = []
            for r in mine:
                same = (columns == sig[r][:, None]).sum(axis=0)
                best = int(same.argmax())
                if same[best] >= least * len(columns) and ids[r] != ids[others[best]]:
                    found.append((ids[r], ids[others[best]]))
            if found:
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return (both.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
            .mapInArrow(run, "a long, b long"))


def families(reps: DataFrame, depth: int, threshold: float, block_rows: int) -> DataFrame:
    """(a, b) edges between texts that share a trie node and whose signatures allow the
    threshold, in rounds from ``depth`` on; after the first only from texts that have no edge yet.
    ``reps``: rep, sig."""
    shortest = depth
    while shortest > 1 and 1 - recall(threshold, shortest) > MISSED:
        shortest -= 1
    values = TREES * DEPTH
    least = threshold - SLACK * (threshold * (1 - threshold) / values) ** 0.5
    rows = forest(reps, shortest)
    sigs = written(reps.join(rows.select("rep").distinct(), "rep", "left_semi")
                   .select("rep", low_bytes(F.col("sig")).alias("low")), "low-signatures")
    first = _level(rows.filter(F.col("tree") < FIRST_TREES), depth)
    edges = written(first_families(first, sigs, least), "first-edges")
    found = written(components(edges).toDF("rep", "family"), "first-families")
    large = found.groupBy("family").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= BIG).select("family")
    settled = written(found.join(large, "family").select("rep", "family"), "settled")
    rows = written(rows.join(settled.hint("merge"), "rep", "left"), "forest-classes")
    asked = None
    for d in range(depth, shortest - 1, -1):
        if d == depth:
            level = _level(rows, d).withColumn("asks", F.lit(True))
        else:
            paired = edges.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
            level = _level(rows, d).join(paired.withColumn("_paired", F.lit(True)).hint("merge"), "rep", "left")
            level = level.withColumn("asks", F.col("_paired").isNull()).drop("_paired")
        texts = level.filter("family IS NULL").drop("family")
        made = written(text_pairs(texts, sigs, least, block_rows), "trie-edges")
        # a class under a node is one row
        classes = level.filter("family IS NOT NULL").select("node", "family").distinct()
        meets = (texts.filter("asks").join(classes.hint("merge"), "node").select("rep", "family").distinct())
        if d == depth:
            other = classes.toDF("node", "_other")
            pairs = classes.join(other.hint("merge"), "node").filter("family < _other").select("family", "_other").distinct()
            meets = meets.unionByName(settled.join(pairs, "family").select("rep", F.col("_other").alias("family")))
        if asked is not None:
            meets = meets.join(asked.hint("merge"), ["rep", "family"], "left_anti")
        meets = written(meets, "class-meetings")
        asked = meets if asked is None else asked.unionByName(meets)
        edges = edges.unionByName(made)
        if not meets.isEmpty():
            edges = edges.unionByName(written(class_pairs(meets, settled, sigs, least, block_rows), "class-edges"))
    return edges


def agreeing(sig: np.ndarray, rows: np.ndarray, least: float) -> np.ndarray:
    """For each of ``rows`` the signatures that agree with it in a share of at least ``least``.
    The first half of the values leaves out those that the second could not make up for."""
    n, values = sig.shape
    half = values // 2
    columns = np.ascontiguousarray(sig.T)
    linked = np.zeros((n, n), bool)
    for r in rows:
        same = (columns[:half] == columns[:half, r, None]).view(np.uint8).sum(axis=0, dtype=np.uint8)
        near = np.flatnonzero(same >= least * values - (values - half))
        rest = np.count_nonzero(sig[near, half:] == sig[r, half:], axis=1)
        linked[r, near] = same[near] + rest >= least * values
    return linked


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairs' intersections: a sum of products of 0/1 columns over those
    shingles that more than one set has."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    rank = np.full(len(times), -1)
    rank[shared] = np.arange(len(shared))
    column = rank[column]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((n, n), np.float32)  # sizes of intersections, far below 2 ** 24
    width = max(1, 4_000_000 // n)
    for at in range(0, len(shared), width):
        a, b = np.searchsorted(column, [at, at + width])
        marks = np.zeros((n, min(width, len(shared) - at)), np.float32)
        marks[owner[a:b], column[a:b] - at] = 1
        total += marks @ marks.T
    return total


def verified(members: DataFrame, threshold: float, n_words: int, block_rows: int,
             block_chars: int) -> DataFrame:
    """Exact links inside families: rows (rep, linked, b) with the documents of other
    classes that a class links with, and rows (rep, 0, b) that span the links. ``members``:
    rep, family, size, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for same, group in groups(batches):
            if group.num_rows < 2:
                continue
            own, ids = group.column(3).to_numpy(), group.column(4).to_numpy()
            _, first = np.unique(ids, return_index=True)  # a repeated row comes once
            own, ids = own[first], ids[first]
            size = group.column(5).to_numpy()[first]
            texts = group.column(6).to_pylist()
            sets = [shingles(texts[k], n_words) for k in first]
            both = intersections(sets)
            counts = np.array([len(s) for s in sets], float)
            linked = both / (counts[:, None] + counts[None, :] - both) >= threshold
            if same:
                np.fill_diagonal(linked, False)
            else:
                linked &= own[:, None] != own[None, :]
            edges = np.array(spanning(linked), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids, ids[edges[:, 0]]])),
                 pa.array(np.concatenate([linked @ size, np.zeros(len(edges), np.int64)])),
                 pa.array(np.concatenate([ids, ids[edges[:, 1]]]))],
                names=["rep", "linked", "b"])

    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block_rows),
                        F.ceil(F.sum(F.length("text")) / block_chars))
    dealt = block_pairs(members, "family", F.xxhash64("rep"), blocks, "large-families",
                        ["rep", "size", "text"])
    return dealt.mapInArrow(run, "rep long, linked long, b long")


def decided(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            n_words: int = WORDS, threshold: float = THRESHOLD,
            target_recall: float = TARGET_RECALL, block_rows: int = BLOCK_ROWS,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The columns of ``jaccard_join`` and cls, the md5 of the text, null where a row takes no
    part. A class of equal texts is one node, whatever ids its rows have."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    signed = written(signatures(texts, n_words), "signatures")
    usable = signed.filter("doc_id IS NOT NULL AND sig IS NOT NULL")
    # a written number for each class: rep
    classes = written(usable.groupBy("cls").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("size"), F.min("sig").alias("sig"))
        .withColumn("rep", F.monotonically_increasing_id()), "text-classes")
    reps, classes = classes.select("rep", "sig"), classes.drop("sig")
    depth = matched_depth(threshold, target_recall)
    spark = docs.sparkSession
    family = distilled(spark, lambda: components(families(reps, depth, threshold, block_rows))
                       .toDF("rep", "family").join(classes, "rep"), "families")
    members = (texts.select(F.col("doc_id").alias("first"), F.md5("text").alias("cls"), "text")
               .join(family.hint("merge"), ["first", "cls"]).select("rep", "family", "size", "text"))
    links = written(verified(members, threshold, n_words, block_rows, block_chars), "exact-links")
    counted = links.groupBy("rep").agg(F.sum("linked").alias("linked"))
    joined = distilled(spark, lambda: components(links.filter("rep <> b").select(F.col("rep").alias("a"), "b"))
                       .toDF("rep", "component"), "link-components")
    # the smallest document of a component; of its texts under that id, the one of smallest md5
    least = (joined.join(classes, "rep").groupBy("component")
             .agg(F.min(F.struct("first", "cls")).alias("least")))
    about = (classes.join(counted, "rep", "left")
             .join(joined.join(least, "component"), "rep", "left")
             .select("cls", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("_links"),
                     F.coalesce("least.first", "first").alias("_class"),
                     F.coalesce("least.cls", "cls").alias("_least")))
    rows = signed.select("doc_id", F.when(F.col("sig").isNotNull() & F.col("doc_id").isNotNull(),
                                          F.col("cls")).alias("cls"))
    own = F.coalesce(F.col("cls") == F.col("_least"), F.lit(True))
    return (rows.join(about, "cls", "left")
            .select("doc_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("_class", "doc_id").alias("class_id"), own.alias("_own"), "cls")
            .select("doc_id", "n_links", "class_id", F.coalesce(
                (F.col("doc_id") == F.col("class_id")) & F.col("_own"), F.lit(False)).alias("kept"), "cls"))


def jaccard_join(docs: DataFrame, *args, **options) -> DataFrame:
    """One row for each document: doc_id, n_links (other documents at the threshold or
    above), class_id (smallest doc_id that links reach), kept (it is that document; of
    several linked texts under that id the one with the smallest md5). Arguments as of
    ``decided``."""
    return decided(docs, *args, **options).drop("cls")
