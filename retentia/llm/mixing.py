"""Mixing sources to target weights by systematic sampling (operator 7).

Every source gets a target share of all words by weight; a target stops at
``max_repeats`` times the source's size and the excess goes to the others by weight
until none is above. Each document of a source then expects ``target / size``
copies. The expected copies are prefix-summed within the source, one random offset
is added, and a document is emitted once for each integer boundary that its
interval crosses.

The prefix sum needs no task that holds a source: documents are dealt into buckets
(leading bits of the size, hash of the id) within the source, the buckets are counted with partial sums, and
a document's position is the count before its bucket plus its rank inside. Ordering
by size first stratifies the sample, so that a source's taken words come near its
target.

Defined results: null text has size 0; very long texts are counted whole; a null source is a source of its own, last
in order; a source of size 0 has target 0 and takes nothing; repeated rows are
separate documents; an empty table gives an empty result; of the input's columns
only those named are read, so others may clash with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = 20240607
# A bucket (one window partition) holds no more rows than this on average, and a
# source is dealt into no fewer parts than MIN_PARTS at any size.
ROWS_PER_BUCKET = 200_000
MIN_PARTS = 4


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hashed(text: Column) -> Column:
    """0 to 2**32 - 1 from the first eight hex digits of the md5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def size_band(size: Column) -> Column:
    """Bit length and the four bits after the first: bands of a sixteenth of an octave."""
    bits = F.length(F.bin(size))
    return (bits * 16 + F.call_function("shiftright", size, F.greatest(bits - 5, F.lit(0))) % 16
            ).cast("int")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> also weight and target, one row for each source.

    A source's target is ``min(max_repeats * size, level * weight)``. The sources that
    reach their ceiling are the first in order of size by weight, so the level follows
    from prefix sums in that order. Sources are few (one row each, already summed);
    these windows run over that table alone.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").isNull(), "source")
    by_ratio = every.orderBy("_ratio", F.col("source").isNull(), "source")
    ranked = (sizes
              .withColumn("weight", F.element_at(
                  F.array(*[F.lit(w) for w in weights]),
                  ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
              .withColumn("_ratio", F.col("source_size") / F.col("weight"))
              .withColumn("_all", F.sum("source_size").over(every)))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    ceiling = F.col("source_size") * F.lit(max_repeats)
    level = ((F.col("_all") - F.coalesce(F.sum(ceiling).over(before), F.lit(0)))
             / F.sum("weight").over(after))
    stopped = F.col("_level") * F.col("weight") >= ceiling
    return (ranked.withColumn("_level", level)
            # the level of the first source that does not stop holds for all after it
            .withColumn("_open", F.min(F.when(~stopped, F.struct("_ratio", F.col("source").isNull(),
                                                                 "source", "_level")))
                        .over(every)["_level"])
            .withColumn("target", F.when(F.col("_open").isNull(), ceiling.cast("double"))
                        .otherwise(F.least(ceiling.cast("double"),
                                           F.col("_open") * F.col("weight"))))
            .select("source", "source_size", "weight", "target"))


def systematic_copies(docs: DataFrame, text_col: str = "text", source_col: str = "source",
                      id_col: str = "doc_id", weights: tuple[int, ...] = WEIGHTS,
                      max_repeats: int = MAX_REPEATS, seed: int = SEED,
                      rows_per_bucket: int = ROWS_PER_BUCKET,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: doc_id, source, size, source_size, target, copies, taken,
    and the columns of ``keep``."""
    one = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                      word_count(F.col(text_col)).alias("size"),
                      F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("_h"),
                      *[F.col(c).alias(f"_keep_{c}") for c in keep])
    n_parts = max(MIN_PARTS, -(-docs.count() // rows_per_bucket))
    dealt = one.withColumns({
        "_band": size_band(F.col("size")),
        "_part": (hashed(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                  % n_parts).cast("int"),
    })
    key = ["source", "_band", "_part"]
    counts = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_size"))
    targets = source_targets(counts.groupBy("source").agg(F.sum("_size").alias("source_size")),
                             weights, max_repeats)
    order = (Window.partitionBy("_s").orderBy("_band", "_part")
             .rowsBetween(Window.unboundedPreceding, -1))
    safe = F.struct(F.col("source").isNull().alias("none"),
                    F.coalesce("source", F.lit("")).alias("name"))
    buckets = (counts.withColumn("_s", safe)
               .withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
               .join(targets.withColumn("_s", safe).drop("source"), "_s")
               .select("_s", "_band", "_part", "_before", "source_size", "target"))
    inside = Window.partitionBy("_s", "_band", "_part").orderBy("size", "doc_id", "_h")
    placed = (dealt.withColumn("_s", safe)
              .withColumn("_rank", F.row_number().over(inside))
              .join(buckets, ["_s", "_band", "_part"], "left"))
    rate = F.when(F.col("source_size") > 0,
                  F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = hashed(F.concat(F.lit(f"{seed}:"), F.col("_s.name"))) / F.lit(float(1 << 32))
    upto = F.floor(F.col("_offset") + F.col("_rate") * (F.col("_before") + F.col("_rank")))
    below = F.floor(F.col("_offset") + F.col("_rate") * (F.col("_before") + F.col("_rank") - 1))
    # an interval of length r crosses ceil(r) integers at most; doubles may say one more
    crossed = F.least(upto - below, F.ceil("_rate"))
    return (placed.withColumns({"_rate": rate, "_offset": offset})
            .withColumn("copies", crossed.cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"),
                    *[F.col(f"_keep_{c}").alias(c) for c in keep]))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as it is taken."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(options.get("id_col", "doc_id")).alias("_id"),
                        F.col(options.get("text_col", "text")).alias("_text"),
                        F.col(options.get("source_col", "source")).alias("_source"))
    taken = systematic_copies(whole, keep=("row",), **{
        **options, "id_col": "_id", "text_col": "_text", "source_col": "_source"})
    return (taken.filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("row.*"))
