"""Top-n selection by counting, without a sort, shuffle or checkpoint of rows (O-61..O-64, O-109).

To keep the best n of N rows one only needs the key of the n-th row. It is found by
refining a bracket around it, for every group and budget in the same passes:

1. A pass sketches the rows inside each open bracket (``percentile_approx``, merged
   map-side) and takes two values around the estimated place of the n-th row.
2. The next pass counts exactly how many rows lie above, at, between and below the two
   values, and sketches the rows between them. The count names the part that holds the
   n-th row, so a bad estimate costs a pass, never a wrong row.
3. When a single value remains and not all its rows are wanted, the same goes on with
   the first tie-break column among those rows, then the second.

A pass reads the key columns and returns one row a group. Each narrows a bracket about
``POINTS / 3`` times, so 10^11 distinct scores take five. Selecting is then a
comparison of (score, tie-breaks) with the border key, inside the scan's stage.

Order: score descending, then each tie-break ascending. A null or NaN score counts as the
lowest, together with negative infinity; a null tie-break comes first. Rows that repeat
the border key whole are all selected (the keys are meant to be unique). An empty frame
has no border and selects nothing. Each pass reads its input again: give a written table,
or its key columns written once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ntz_micros, top_n
from .rank import grouped_row_number, join_on_keys

POINTS = 1000  # quantiles read from a sketch; a bracket spans three of them
ACCURACY = 10_000  # rank error of a sketch: 1 / ACCURACY of its rows
MAX_GROUPS = 10_000  # groups whose borders the driver holds; beyond, rows are ranked instead
LOWEST, HIGHEST = float("-inf"), float("inf")
LOW_BITS = 53  # a long is compared as two parts that doubles hold exactly
TIE = ("CustomerID", "invoice_month")


@dataclass
class Border:
    """The key of the n-th row of one group under one budget."""

    group: tuple
    budget: float
    total: int
    n: int
    keys: list = field(default_factory=list)  # values found so far, score first
    left: int = 0  # rank of the wanted row inside the bracket, from the top
    lo: float | None = None  # open bracket
    hi: float | None = None
    a: float | None = None  # the two values counted in the next pass
    b: float | None = None
    done: bool = False

    def narrow(self, lo, hi, left):
        self.lo, self.hi, self.left, self.a, self.b = lo, hi, left, None, None

    def found(self, value, rank, ties):
        self.keys.append(value)
        self.narrow(None, None, rank)
        self.done = rank >= ties  # every row of the value is wanted: no tie to break

    def refine(self, row, j: int) -> bool:
        """Take in one pass's counts; true once this key's value is found."""
        above, at_b, mid, at_a = (row[f"_{c}{j}"] for c in ("above", "atb", "mid", "ata"))
        if self.left <= above:
            self.narrow(self.b, self.hi, self.left)
        elif self.left <= above + at_b:
            self.found(self.b, self.left - above, at_b)
            return True
        elif self.left <= above + at_b + mid:
            self.narrow(self.a if self.a is not None else self.lo, self.b if self.b is not None else self.hi,
                        self.left - above - at_b)
            self.a, self.b = row[f"_a{j}"], row[f"_b{j}"]
        elif self.left <= above + at_b + mid + at_a:
            self.found(self.a, self.left - above - at_b - mid, at_a)
            return True
        else:
            self.narrow(self.lo, self.a, self.left - above - at_b - mid - at_a)
        return False


def order_keys(df: DataFrame, score: str, tie_break: Sequence[str] = TIE, digits: int | None = None) -> list[Column]:
    """Columns of doubles whose descending order is the selection's order: the score, then
    the negated tie-breaks (integer, date, timestamp or boolean). A long gives two columns,
    its upper bits and its lower 53, so that every value is exact."""
    x = F.col(score).cast("double")
    x = F.round(x, digits) if digits is not None else x
    keys = [F.coalesce(F.when(~F.isnan(x), x + F.lit(0.0)), F.lit(LOWEST))]
    types = dict(df.dtypes)
    for c in tie_break:
        t = types[c]
        if t in ("tinyint", "smallint", "int", "boolean"):
            parts = [F.col(c).cast("int")]
        elif t == "date":
            parts = [F.unix_date(c)]
        elif t in ("bigint", "timestamp", "timestamp_ntz"):
            k = F.col(c) if t == "bigint" else F.unix_micros(c) if t == "timestamp" else ntz_micros(c)
            parts = [F.shiftright(k, LOW_BITS), k.bitwiseAND(F.lit((1 << LOW_BITS) - 1))]
        else:
            raise TypeError(f"tie-break column {c} has type {t}; integer, date, timestamp or boolean needed")
        keys += [F.coalesce(-k.cast("double"), F.lit(HIGHEST)) for k in parts]
    return keys


def _pass(keyed: DataFrame, groups: list[str], level: int, cells: dict[tuple, dict[int, Border]]) -> list:
    """Counts and next values of every open cell: one aggregate, one row a group."""
    slots = sorted({j for c in cells.values() for j in c})
    names = [(f"_{w}{j}", "double") for j in slots for w in ("lo", "hi", "pa", "pb")]
    names += [(f"_left{j}", "bigint") for j in slots]
    names += [(f"_f{j}_{i}", "double") for j in slots for i in range(level)]

    def values(by_slot):
        out = []
        for j in slots:
            c = by_slot.get(j)
            out += [c.lo, c.hi, c.a, c.b] if c else [None] * 4
        out += [by_slot[j].left if j in by_slot else None for j in slots]
        return out + [by_slot[j].keys[i] if j in by_slot else None for j in slots for i in range(level)]

    if groups:
        types = dict(keyed.dtypes)
        schema = ", ".join([f"`{g}` {types[g]}" for g in groups] + [f"{n} {t}" for n, t in names])
        table = keyed.sparkSession.createDataFrame([(*g, *values(c)) for g, c in cells.items()], schema)
        rows = join_on_keys(keyed, table, groups, "inner", broadcast_right=True)  # MAX_GROUPS rows at most
    else:
        rows = keyed.select("*", *[F.lit(v).cast(t).alias(n) for (n, t), v in zip(names, values(cells[()]))])
    x = F.col(f"_k{level}")
    aggs = []
    for j in slots:
        lo, hi, a, b = (F.col(f"_{w}{j}") for w in ("lo", "hi", "pa", "pb"))
        inside = F.col(f"_left{j}").isNotNull() & (lo.isNull() | (x > lo)) & (hi.isNull() | (x < hi))
        for i in range(level):
            inside = inside & (F.col(f"_k{i}") == F.col(f"_f{j}_{i}"))
        mid = inside & (a.isNull() | (x > a)) & (b.isNull() | (x < b))
        aggs += [F.count_if(inside & b.isNotNull() & (x > b)).alias(f"_above{j}"),
                 F.count_if(inside & b.isNotNull() & (x == b)).alias(f"_atb{j}"),
                 F.count_if(mid).alias(f"_mid{j}"),
                 F.count_if(inside & a.isNotNull() & (x == a) & (b.isNull() | (a < b))).alias(f"_ata{j}"),
                 F.percentile_approx(F.when(mid, x), [i / POINTS for i in range(POINTS + 1)],
                                     ACCURACY).alias(f"_grid{j}"),
                 F.first(f"_left{j}", ignorenulls=True).alias(f"_left{j}")]
    out = rows.groupBy(*groups).agg(*aggs)
    picks = []
    for j in slots:
        rank = F.col(f"_left{j}") - F.col(f"_above{j}") - F.col(f"_atb{j}")
        m = F.greatest(F.col(f"_mid{j}"), F.lit(1))
        at = F.floor((F.lit(1.0) - (rank - F.lit(0.5)) / m) * POINTS)
        at = F.greatest(F.lit(0), F.least(F.lit(POINTS), at)).cast("int")  # a rank far outside is no int
        picks += [F.get(f"_grid{j}", F.greatest(F.lit(0), at - 1)).alias(f"_a{j}"),
                  F.get(f"_grid{j}", F.least(F.lit(POINTS), at + 2)).alias(f"_b{j}")]
        picks += [F.col(f"_{w}{j}") for w in ("above", "atb", "mid", "ata")]
    return out.select(*groups, *picks).collect()


def borders(df: DataFrame, score: str, budgets: Sequence[float], groups: Sequence[str] = (),
            tie_break: Sequence[str] = TIE, digits: int | None = None) -> list[Border] | None:
    """The border of the best ``top_n(rows of the group, budget)`` rows of each group and
    budget; None if there are more than ``MAX_GROUPS`` groups. ``digits`` rounds scores
    before they are compared."""
    groups, budgets = list(groups), [float(k) for k in budgets]
    keys = order_keys(df, score, tie_break, digits)
    keyed = df.select(*groups, *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    sizes = keyed.groupBy(*groups).agg(F.count(F.lit(1)).alias("_total"))
    sizes = sizes.select("*", *[top_n(F.col("_total"), k).alias(f"_n{j}") for j, k in enumerate(budgets)])
    found = [r for r in sizes.limit(MAX_GROUPS + 1).collect() if r["_total"]]
    if len(found) > MAX_GROUPS:
        return None
    cells = {}
    for r in found:
        g = tuple(r[c] for c in groups)
        cells[g] = [Border(g, k, r["_total"], r[f"_n{j}"], left=r[f"_n{j}"], done=r[f"_n{j}"] >= r["_total"])
                    for j, k in enumerate(budgets)]
    for level in range(len(keys)):
        open_ = {g: {j: b for j, b in enumerate(bs) if not b.done} for g, bs in cells.items()}
        open_ = {g: by for g, by in open_.items() if by}
        while open_:
            for r in _pass(keyed, groups, level, open_):
                g = tuple(r[c] for c in groups)
                open_[g] = {j: b for j, b in open_[g].items() if not b.refine(r, j)}
            open_ = {g: by for g, by in open_.items() if by}
    for bs in cells.values():
        for b in bs:  # keys that no tie needed: any value passes
            b.keys += [LOWEST] * (len(keys) - len(b.keys))
    return [b for bs in cells.values() for b in bs]


def _selected(keys: Sequence[Column], border: Border) -> Column:
    return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]) >= F.struct(
        *[F.lit(v).alias(f"k{i}") for i, v in enumerate(border.keys)])


def flag_name(budget: float) -> str:
    return f"target_k{int(round(budget * 100)):02d}"


def target_flags(df: DataFrame, policy_col: str, budgets: Sequence[float], tie_break: Sequence[str] = TIE,
                 digits: int | None = None, written: DataFrame | None = None) -> DataFrame:
    """0/1 flag per budget (O-62), named by the rounded percent. ``written``: a written
    table with the same key columns, read by the passes instead of ``df``."""
    found = borders(df if written is None else written, policy_col, budgets, (), tie_break, digits)
    keys = order_keys(df, policy_col, tie_break, digits)
    flags = [_selected(keys, b).cast("int").alias(flag_name(b.budget)) for b in found]
    flags = flags or [F.lit(0).alias(flag_name(k)) for k in budgets]  # an empty frame
    return df.select("*", *flags)


def top_k_slice(df: DataFrame, policy_col: str, k: float, tie_break: Sequence[str] = TIE,
                digits: int | None = None) -> DataFrame:
    """Rows in the top fraction k by policy (O-61)."""
    found = borders(df, policy_col, [k], (), tie_break, digits)
    return df.filter(_selected(order_keys(df, policy_col, tie_break, digits), found[0])) if found else df.limit(0)


def target_lists(flagged: DataFrame, budgets: Sequence[float]) -> DataFrame:
    """The rows of each budget's list (O-63) with ``budget_k``, from the columns of ``target_flags``."""
    hits = F.array(*[F.when(F.col(flag_name(k)) == 1, F.lit(float(k))) for k in budgets])
    return (flagged.withColumn("_hits", F.filter(hits, lambda k: k.isNotNull()))
            .filter(F.size("_hits") > 0).withColumn("budget_k", F.explode("_hits")).drop("_hits"))


def top_rows(df: DataFrame, score: str, budgets: Sequence[float], groups: Sequence[str],
             tie_break: Sequence[str] = TIE, digits: int | None = None) -> DataFrame:
    """Each group's best rows under every budget (O-64): the rows of ``df`` with ``budget_k``,
    ``_n`` (rows selected) and ``_n_rows`` (rows of the group). Beyond ``MAX_GROUPS`` groups
    the rows are ranked by group instead."""
    groups = list(groups)
    found = borders(df, score, budgets, groups, tie_break, digits)
    keys = order_keys(df, score, tie_break, digits)
    if found is None:
        ranked = grouped_row_number(df, groups, [k.desc() for k in keys], "_rank", "_n_rows", bounded_groups=False)
        return (ranked.withColumn("budget_k", F.explode(F.array(*[F.lit(float(k)) for k in budgets])))
                .withColumn("_n", top_n(F.col("_n_rows"), F.col("budget_k")))
                .filter(F.col("_rank") <= F.col("_n")).drop("_rank"))
    types = dict(df.dtypes)
    schema = ", ".join([*[f"`{g}` {types[g]}" for g in groups], "_n_rows bigint", "_cuts array<struct<budget_k:double,"
                       "n:bigint," + ",".join(f"k{i}:double" for i in range(len(keys))) + ">>"])
    by_group: dict[tuple, list] = {}
    for b in found:
        by_group.setdefault((*b.group, b.total), []).append((b.budget, b.n, *b.keys))
    table = df.sparkSession.createDataFrame([(*g, cuts) for g, cuts in by_group.items()], schema)
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    # the groups' borders: MAX_GROUPS rows at most
    rows = join_on_keys(df.withColumn("_key", key), table, groups, "inner", broadcast_right=True)
    wanted = F.filter("_cuts", lambda c: F.col("_key") >= F.struct(*[c[f"k{i}"].alias(f"k{i}")
                                                                     for i in range(len(keys))]))
    return (rows.withColumn("_cuts", wanted).filter(F.size("_cuts") > 0).withColumn("_cut", F.explode("_cuts"))
            .withColumn("budget_k", F.col("_cut.budget_k")).withColumn("_n", F.col("_cut.n"))
            .drop("_cuts", "_cut", "_key"))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Each column's median as numpy gives it (the mean of the two middle values), all columns in
    the same passes; null and NaN are left out, a column without values gives None. A pass holds a sketch and
    a few counts a column, however many distinct values there are. Each pass reads its input again."""
    columns = list(columns)
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), (F.col(c).cast("double") + F.lit(0.0)).alias("_k0"))
                                for i, c in enumerate(columns)])).alias("_s")
    rows = df.select(cells).select("_s.*").filter("_k0 IS NOT NULL AND NOT isnan(_k0)")
    open_, found = {}, {}
    for r in rows.groupBy("_c").agg(F.count(F.lit(1)).alias("_n")).collect():  # a row a column
        n, g = r["_n"], (r["_c"],)
        found[g] = [Border(g, 0.0, n, k, left=k) for k in sorted({(n + 1) // 2, n // 2 + 1})]  # one if n is odd
        open_[g] = dict(enumerate(found[g]))
    while open_:
        for r in _pass(rows, ["_c"], 0, open_):
            g = (r["_c"],)
            open_[g] = {j: b for j, b in open_[g].items() if not b.refine(r, j)}
        open_ = {g: by for g, by in open_.items() if by}
    middle = {columns[g[0]]: [b.keys[0] for b in bs] for g, bs in found.items()}
    return {c: (a if (a := middle[c][0]) == (b := middle[c][-1]) else (a + b) / 2) if c in middle else None
            for c in columns}
