"""Global ordering primitives without a single-partition step (O-45, O-60, O-70).

An un-partitioned ``Window.orderBy`` moves every row into one task. Instead:

1. ``repartitionByRange(n, key)`` on a *unique* composite key (score, then the
   tie-break columns). Spark samples the full composite key, so even a score
   shared by a third of all rows is split across partitions by its tie-break.
2. Inside each range partition, rows are sorted and numbered locally
   (``monotonically_increasing_id`` minus the partition's base id).
3. Per-partition counts (one row per partition: a proven size bound) give the
   offsets, which are broadcast back.

Partition ids must mean the same thing where the rows are numbered and where
the per-partition counts are taken. Two branches of one plan do not guarantee
that: if column pruning makes their range exchanges differ, each samples its own
bounds. The numbered table is therefore cut with a reliable ``checkpoint`` (in
the cluster's ``spark.checkpoint.dir``) and both uses read that one copy, which
also stays consistent when an executor is lost and a partition is recomputed.
The exchange carries an explicit partition count, so adaptive execution never
coalesces it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _ncols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return int(n)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _offsets(counts: DataFrame, value_cols: Sequence[str], total_col: str | None = None) -> DataFrame:
    """Exclusive running totals per partition id. ``counts`` has one row per
    range partition (a bound set by the partition count), so it is collected, summed
    in order on the driver and broadcast back -- no single-partition exchange."""
    rows = sorted(counts.collect(), key=lambda r: r["_pid"])
    types = dict(counts.dtypes)
    running = {c: (0.0 if types[c] in ("double", "float") else 0) for c in value_cols}
    out = []
    for r in rows:
        out.append((r["_pid"], *[running[c] for c in value_cols]))
        for c in value_cols:
            running[c] += r[c] or 0
    schema = ", ".join(["_pid int"] + [f"_off_{c} {'double' if types[c] in ('double', 'float') else 'bigint'}"
                                        for c in value_cols])
    off = counts.sparkSession.createDataFrame(out, schema)
    if total_col:
        off = off.withColumn(total_col, F.lit(running[value_cols[0]]).cast("long"))
    return F.broadcast(off)


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                 broadcast_right: bool = False) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (a NULL group is a group)."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    if broadcast_right:
        r = F.broadcast(r)
    cond = [left[k].eqNullSafe(r[f"_rk_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_rk_{k}" for k in keys])


def global_row_number(df: DataFrame, order: Sequence[Column | str], rank_col: str = "rank",
                      num_partitions: int | None = None, total_col: str | None = None) -> DataFrame:
    """Exact 1..N position of each row in ``order`` (which must be a total order,
    i.e. end with unique tie-break columns). ``total_col`` adds N to every row."""
    order = _ncols(order)
    n = _num_partitions(df, num_partitions)
    local = cut_lineage(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
          .withColumn("_pid", F.spark_partition_id())
          .withColumn("_loc", F.monotonically_increasing_id()
                      - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(counts, ["_n"], total_col)  # the grand total rides along
    return (local.join(offsets, "_pid", "left")
            .withColumn(rank_col, (F.coalesce(F.col("_off__n"), F.lit(0)) + F.col("_loc") + 1).cast("long"))
            .drop("_pid", "_loc", "_off__n"))


def global_cumsum(df: DataFrame, order: Sequence[Column | str], value_cols: Sequence[str],
                  prefix: str = "cum_", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` along a total ``order``.
    Local sums are a window per range partition (balanced by construction)."""
    order = _ncols(order)
    n = _num_partitions(df, num_partitions)
    rp = cut_lineage(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    counts = rp.groupBy("_pid").agg(*[F.sum(c).alias(c) for c in value_cols])
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rp.select("*", *[F.sum(c).over(w).alias(f"_loc_{c}") for c in value_cols])
    out = local.join(_offsets(counts, value_cols), "_pid", "left")
    for c in value_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_loc_{c}") + F.coalesce(F.col(f"_off_{c}"), F.lit(0)))
    return out.drop("_pid", *[f"_loc_{c}" for c in value_cols], *[f"_off_{c}" for c in value_cols])


def grouped_row_number(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column | str],
                       rank_col: str = "rank", count_col: str | None = "group_rows",
                       num_partitions: int | None = None, bounded_groups: bool = True) -> DataFrame:
    """Row number within each group, skew-safe: one global numbering over
    (group, order), minus each group's first position. A hot group is spread
    over many range partitions instead of one window task.

    ``bounded_groups``: the caller guarantees few groups (policies, budgets,
    segments, months), so the one-row-per-group table is broadcast; otherwise
    the join is left to adaptive execution (runtime size, skew-join split)."""
    g = list(group_cols)
    if not g:
        out = global_row_number(df, order, rank_col, num_partitions, count_col)
        return out
    ranked = global_row_number(df, [*g, *order], "_grn", num_partitions)
    aggs = [F.min("_grn").alias("_gfirst")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    firsts = ranked.groupBy(*g).agg(*aggs)
    return (join_on_keys(ranked, firsts, g, "left", broadcast_right=bounded_groups)
            .withColumn(rank_col, F.col("_grn") - F.col("_gfirst") + 1)
            .drop("_grn", "_gfirst"))


def policy_order(policy_col: str, tie_break: Sequence[str] = ("CustomerID", "invoice_month"),
                 digits: int = 6) -> list[Column]:
    """Descending by the policy value (rounded, so engines agree on ties), then the
    documented tie-break. Nulls go last."""
    return [F.round(F.col(policy_col), digits).desc_nulls_last(), *[F.col(c).asc() for c in tie_break]]


def rank_by_policy(df: DataFrame, policy_col: str, rank_col: str = "rank",
                   tie_break: Sequence[str] = ("CustomerID", "invoice_month")) -> DataFrame:
    """Global rank by a policy column, descending (O-60)."""
    return global_row_number(df, policy_order(policy_col, tie_break), rank_col)


def average_ranks(df: DataFrame, specs: Sequence[tuple[str, str, bool]]) -> tuple[DataFrame, dict]:
    """Ranks with ties averaged (pandas ``method='average'``) for several columns
    at once (O-45). ``specs``: (column, output column, ascending). Nulls get null.

    Rows are first reduced to (column, value, count) -- map-side combined, so a
    hot value costs one row -- then one grouped running sum over the distinct
    values gives rows_before; average rank = rows_before + (count + 1) / 2. Each
    column takes its ranks back from its value table, in a way that no hot value can
    fill one task: a table of at most ``BROADCAST_VALUES`` values is broadcast; of a
    larger one the values that hold more than 1 / ``HOT_SHARE`` of the rows (fewer than
    ``HOT_SHARE`` of them) are, and the others' rows are shuffled, while rows of hot
    values and nulls are spread.
    Also returns {output column: (min rank, max rank)} from the small table."""
    items = [F.struct(F.lit(out).alias("_f"), F.col(c).cast("double").alias("_x"),
                      (F.col(c) if asc else -F.col(c)).cast("double").alias("_v"))
             for c, out, asc in specs]
    long = df.select(F.explode(F.array(*items)).alias("_s")).select("_s._f", "_s._x", "_s._v")
    counts = long.filter(F.col("_v").isNotNull()).groupBy("_f", "_v").agg(
        F.count(F.lit(1)).alias("_c"), F.max("_x").alias("_x"))
    cum = global_cumsum(counts, [F.col("_f"), F.col("_v")], ["_c"])
    starts = cum.groupBy("_f").agg(F.min(F.col("cum__c") - F.col("_c")).alias("_s"))
    per = cum.join(F.broadcast(starts), "_f").select(
        "_f", "_x", "_c", ((F.col("cum__c") - F.col("_c") - F.col("_s")) + (F.col("_c") + 1) / 2.0).alias("_r"))
    per = cut_lineage(per)
    stats = {r["_f"]: r for r in per.groupBy("_f").agg(  # a row a column
        F.min("_r").alias("lo"), F.max("_r").alias("hi"), F.count(F.lit(1)).alias("values"),
        F.sum("_c").alias("rows")).collect()}
    bounds = {f: (r["lo"], r["hi"]) for f, r in stats.items()}
    out = df
    for c, name, _ in specs:
        vals = per.filter(F.col("_f") == name).select(F.col("_x").alias(f"_k_{name}"), F.col("_r").alias(name), "_c")
        if name not in stats or stats[name]["values"] <= BROADCAST_VALUES:
            out = _with_rank(out, c, name, F.broadcast(vals.drop("_c")))
            continue
        hot = F.col("_c") > stats[name]["rows"] / HOT_SHARE
        out = _with_rank(out, c, name, F.broadcast(vals.filter(hot).drop("_c"))).withColumnRenamed(name, f"_h_{name}")
        spread = F.pmod(F.xxhash64(*[k for k, t in df.dtypes if "map<" not in t]), F.lit(HOT_SHARE)) + 1
        out = out.withColumn("_salt", F.when(F.col(f"_h_{name}").isNotNull() | F.col(c).isNull(), spread).otherwise(0))
        # 0 for every value; a literal would leave the join's key and thereby the shuffle
        cold = vals.filter(~hot).select(f"_k_{name}", name, F.least(F.col("_c"), F.lit(0)).alias("_salt0"))
        out = out.join(cold, (F.col(c).cast("double") == F.col(f"_k_{name}")) & (F.col("_salt") == F.col("_salt0")), "left")
        out = (out.withColumn(name, F.coalesce(f"_h_{name}", name))
               .drop(f"_k_{name}", f"_h_{name}", "_salt", "_salt0"))
    return out, bounds


BROADCAST_VALUES = 100_000  # rows (value, rank) of a value table that every task may hold
HOT_SHARE = 1000


def _with_rank(rows: DataFrame, c: str, name: str, vals: DataFrame) -> DataFrame:
    return rows.join(vals, F.col(c).cast("double") == F.col(f"_k_{name}"), "left").drop(f"_k_{name}")


def average_rank(df: DataFrame, value_col: str, out_col: str, ascending: bool = True,
                 tie_break: Sequence[str] = ("CustomerID", "invoice_month")) -> DataFrame:
    """Single-column form of ``average_ranks``."""
    return average_ranks(df, [(value_col, out_col, ascending)])[0]


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], bounded_groups: bool = False) -> DataFrame:
    """numpy-style linear quantiles per group, exact and distributed: rows are reduced
    to counts of distinct values (map-side combined), the counts get running sums, and the
    two values around each quantile position are kept. Output: group cols, q (double),
    value. Nulls are ignored."""
    return quantiles_of(value_counts(df.filter(F.col(value_col).isNotNull()), group_cols, value_col),
                        group_cols, probs, bounded_groups)


def value_counts(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """group cols, _v (each distinct value as double, null among them), _c (its rows) and cum__c, the running sum of
    _c by (group, value), nulls first. Cut once: several uses read the counts, not the rows."""
    g = list(group_cols)
    counts = df.groupBy(*g, F.col(value_col).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    return global_cumsum(counts, [*[F.col(c) for c in g], F.col("_v")], ["_c"])


def quantiles_of(counts: DataFrame, group_cols: Sequence[str], probs: Sequence[float],
                 bounded_groups: bool = False) -> DataFrame:
    """``exact_quantiles`` from the ``value_counts`` of the rows."""
    g = list(group_cols)
    cum = counts.filter(F.col("_v").isNotNull())
    if g:
        spans = cum.groupBy(*g).agg(F.min(F.col("cum__c") - F.col("_c")).alias("_s"), F.sum("_c").alias("_cnt"))
        cum = join_on_keys(cum, spans, g, "left", broadcast_right=bounded_groups)
    else:
        total = cum.agg(F.max("cum__c")).first()[0]
        cum = cum.withColumn("_s", F.lit(0)).withColumn("_cnt", F.lit(total).cast("long"))
    upto, qs = F.col("cum__c") - F.col("_s"), F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("q")
    pos = cum.select(*g, "_v", upto.alias("_hi"), (upto - F.col("_c")).alias("_lo"), "_cnt", qs)
    pos = pos.withColumn("_h", (F.col("_cnt") - 1).cast("double") * F.col("q"))
    at = F.floor("_h").cast("long") + 1  # position from 1 of the lower neighbour
    holds = lambda k: (F.col("_lo") < k) & (k <= F.col("_hi"))
    agg = pos.filter(holds(at) | holds(at + 1)).groupBy(*g, "q").agg(
        F.max(F.when(holds(at), F.col("_v"))).alias("_a"),
        F.max(F.when(holds(at + 1), F.col("_v"))).alias("_b"),
        F.max("_h").alias("_h"))
    frac = F.col("_h") - F.floor(F.col("_h"))
    value = F.when(F.col("_b").isNull() | (frac == 0), F.col("_a")).otherwise(
        F.col("_a") + frac * (F.col("_b") - F.col("_a")))
    return agg.select(*g, "q", value.alias("value"))
