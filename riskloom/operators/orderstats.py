"""Exact order statistics that hold at any table size.

A quantile needs the k-th smallest value.  The built-in exact ``percentile``
keeps one map entry per distinct value in a single task, so it is used only
behind a measured bound on the number of distinct values, and on counted
values rather than rows (a value held by a third of all rows is one entry).
Beyond the bound the k-th value is found by narrowing brackets: every round
counts the rows per slice of each bracket, with map-side combine, and keeps
the slice that holds the wanted rank.  No round shuffles more than the slice
counts, and the result is the exact value.  Slices are equal in value; where
that has hardly narrowed a bracket, the next round slices by order of magnitude,
so values over any number of decades take few rounds.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskloom.functions.expr import col, no_nan, number
from riskloom.session import stage

MAP_LIMIT = 200_000
SLICES = 1024
STUCK = 8  # a round that leaves more than this part of a bracket's rows has not narrowed it
ROWS_PER_TASK = 2_000_000


def numeric_view(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), names: Sequence[str] = ()) -> DataFrame:
    """(by..., one double per column): the cast that each column's type needs, and no more."""
    out = [col(b) for b in by]
    for c, name in zip(columns, names or columns):
        kind = df.schema[c].dataType
        if isinstance(kind, (T.IntegralType, T.DecimalType)):
            x = col(c).cast("double")
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            x = no_nan(col(c).cast("double"))
        else:
            x = number(col(c))
        out.append(x.alias(name))
    return df.select(*out)


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value) with one row per known numeric cell."""
    wide = numeric_view(df, columns, by)
    return wide.unpivot(
        [col(b) for b in by], [col(c) for c in columns], "column", "value"
    ).where(F.col("value").isNotNull())


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value, n): counted values, combined before the shuffle."""
    return long_values(df, columns, by).groupBy(*[col(b) for b in by], "column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


@dataclass(frozen=True)
class Facts:
    """Per group and column: known values, smallest, largest, and the estimated distinct count."""

    cells: Mapping[tuple, tuple[int, float, float, int]]

    def distinct(self, column: str) -> int:
        """Largest estimate of any group."""
        return max((d for key, (_, _, _, d) in self.cells.items() if key[-1] == column), default=0)

    def known(self, column: str) -> int:
        return sum(n for key, (n, _, _, _) in self.cells.items() if key[-1] == column)


def _cell_aggregates(columns: Sequence[str]) -> list:
    return [
        F.expr(f.format(f"_x{i}")).alias(f"{n}{i}")
        for i in range(len(columns))
        # a coarse sketch is enough to choose a way, and keeps many columns in one compact aggregate
        for n, f in (("n", "count({})"), ("a", "min({})"), ("z", "max({})"), ("d", "approx_count_distinct({}, 0.1)"))
    ]


def column_facts(df: DataFrame, columns: Sequence[str]) -> Facts:
    """Facts of all columns over the whole table, in one pass."""
    wide = numeric_view(df, columns, names=[f"_x{i}" for i in range(len(columns))])
    r = wide.agg(*_cell_aggregates(columns)).first()
    return Facts({(c,): (r[f"n{i}"], r[f"a{i}"], r[f"z{i}"], r[f"d{i}"]) for i, c in enumerate(columns)})


def large_cells(df: DataFrame, columns: Sequence[str], by: Sequence[str], limit: int) -> dict[tuple, tuple]:
    """(by..., column) -> (n, smallest, largest) of the cells with more than ``limit`` distinct values.

    All other groups stay where they are, however many: a listed cell holds more than ``limit`` rows.
    """
    wide = numeric_view(df, columns, by, [f"_x{i}" for i in range(len(columns))])
    per_group = wide.groupBy(*[col(b) for b in by]).agg(*_cell_aggregates(columns))
    most = F.greatest(*[F.col(f"d{i}") for i in range(len(columns))], F.lit(0))
    return {
        (*[r[b] for b in by], c): (r[f"n{i}"], r[f"a{i}"], r[f"z{i}"])
        for r in per_group.where(most > limit).collect()
        for i, c in enumerate(columns)
        if r[f"d{i}"] > limit
    }


def few_distinct(
    df: DataFrame, columns: Sequence[str], limit: int, facts: Facts | None = None
) -> dict[str, int | None]:
    """Exact distinct count of each column with at most ``limit`` values, else None.

    The sketch first sorts out the columns that are far above the limit, so the
    exact sets stay small.
    """
    if not columns:
        return {}
    facts = facts or column_facts(df, columns)
    near = [c for c in columns if facts.distinct(c) <= 4 * limit + 20]
    out: dict[str, int | None] = dict.fromkeys(columns)
    if near:
        wide = numeric_view(df, near, names=[f"_x{i}" for i in range(len(near))])
        row = wide.agg(*[F.expr(f"size(collect_set(_x{i}))").alias(f"d{i}") for i in range(len(near))]).first()
        for i, c in enumerate(near):
            out[c] = row[f"d{i}"] if row[f"d{i}"] <= limit else None
    return out


@dataclass(frozen=True)
class _Bracket:
    key: tuple
    low: float
    high: float
    below: int
    ranks: tuple[int, ...]
    size: int = 0  # rows inside
    by_magnitude: bool = False


def select_ranks(
    long: DataFrame,
    keys: Sequence[str],
    wanted: Callable[[tuple, int], Iterable[int]],
    sizes: Mapping[tuple, tuple[int, float, float]] | None = None,
) -> dict[tuple, tuple[int, dict[int, float]]]:
    """Values at given 0-based ranks of ``value`` within each key.

    ``wanted(key, n)`` names the ranks once the group size is known.  Returns
    key -> (n, {rank: value}).  Driver state is one bracket per key and rank,
    so there must be few keys.  ``sizes`` holds (n, smallest, largest) per key
    where they are known already.
    """
    spark = long.sparkSession
    if sizes is None:
        ends = long.groupBy(*[col(k) for k in keys]).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
        )
        sizes = {tuple(r[k] for k in keys): (r["n"], r["lo"], r["hi"]) for r in ends.collect()}
    found: dict[tuple, tuple[int, dict[int, float]]] = {}
    open_brackets: list[_Bracket] = []
    for key, (n, low, high) in sizes.items():
        if n == 0:
            continue
        ranks = tuple(sorted({min(max(int(x), 0), n - 1) for x in wanted(key, n)}))
        found[key] = (n, {})
        if ranks:
            open_brackets.append(_Bracket(key, low, high, 0, ranks, n))

    schema = T.StructType(
        [T.StructField("_b", T.IntegerType())]
        + [T.StructField(f"_k{i}", long.schema[k].dataType) for i, k in enumerate(keys)]
        + [T.StructField("_lo", T.DoubleType()), T.StructField("_hi", T.DoubleType())]
        + [T.StructField("_log", T.BooleanType())]
    )
    v, lo, hi = F.col("value"), F.col("_lo"), F.col("_hi")

    def magnitude(x: Column) -> Column:
        return F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * (F.log(F.abs(x)) + 746.0))  # ln of any double > -746

    even = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    by_size = (magnitude(v) - magnitude(lo)) / (magnitude(hi) - magnitude(lo))
    # infinite ends give no share; any slice will do, as the next round knows the finite ends
    share = F.greatest(F.nanvl(F.when(F.col("_log"), by_size).otherwise(even), F.lit(0.5)), F.lit(0.0))
    # the two ends get slices of their own, so that every round narrows
    part = (
        F.when(v == lo, F.lit(0))
        .when(v == hi, F.lit(SLICES + 1))
        .otherwise(F.least(F.floor(share * SLICES), F.lit(SLICES - 1)).cast("int") + 1)
    )
    while open_brackets:
        todo = []
        for b in open_brackets:
            if b.low == b.high:
                found[b.key][1].update(dict.fromkeys(b.ranks, b.low))
            else:
                todo.append(b)
        if not todo:
            break
        # one row per open bracket: columns x groups x wanted ranks
        table = spark.createDataFrame([(i, *b.key, b.low, b.high, b.by_magnitude) for i, b in enumerate(todo)], schema)
        on = (v >= lo) & (v <= hi)
        for i, k in enumerate(keys):
            on = col(k).eqNullSafe(F.col(f"_k{i}")) & on
        slices: dict[int, list] = {}
        for r in (
            long.join(F.broadcast(table), on)
            .groupBy("_b", part.alias("_s"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
            .collect()
        ):
            slices.setdefault(r["_b"], []).append((r["_s"], r["n"], r["lo"], r["hi"]))
        open_brackets = []
        for i, b in enumerate(todo):
            parts = sorted(slices[i])
            starts, run = [], b.below
            for _, n, _, _ in parts:
                starts.append(run)
                run += n
            hit: dict[int, list[int]] = {}
            for rank in b.ranks:
                hit.setdefault(bisect_right(starts, rank) - 1, []).append(rank)
            for j, ranks in hit.items():
                size = parts[j][1]
                stuck = STUCK * size > b.size and not b.by_magnitude
                open_brackets.append(_Bracket(b.key, parts[j][2], parts[j][3], starts[j], tuple(ranks), size, stuck))
    return found


def _interpolated(n: int, at: dict[int, float], probs: Sequence[float]) -> list[float]:
    out = []
    for p in probs:
        pos = p * (n - 1)
        below, above = math.floor(pos), math.ceil(pos)
        a, b = at[below], at[above]
        out.append(a if a == b else (above - pos) * a + (pos - below) * b)
    return out


def _of_cells(long: DataFrame, keys: Sequence[str], cells: Iterable[tuple], how: str) -> DataFrame:
    """The rows of the given (large, so few) cells, or all others."""
    schema = T.StructType([T.StructField(f"_k{i}", long.schema[k].dataType) for i, k in enumerate(keys)])
    table = long.sparkSession.createDataFrame(list(cells), schema)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & col(k).eqNullSafe(F.col(f"_k{i}"))
    return long.join(F.broadcast(table), on, how)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    map_limit: int = MAP_LIMIT,
    facts: Facts | None = None,
) -> DataFrame:
    """(by..., column, n, q): linearly interpolated quantiles, exact.

    ``q`` is an array in the order of ``probs``.  Columns without values have no row.
    """
    keys = [*by, "column"]
    if by:
        sizes = large_cells(df, columns, by, map_limit)
        small = list(columns)
    else:
        facts = facts or column_facts(df, columns)
        sizes = {k: (n, a, z) for k, (n, a, z, d) in facts.cells.items() if k[-1] in columns and d > map_limit}
        small = [c for c in columns if (c,) not in sizes]
    parts = []
    if small:
        array = "array(" + ",".join(f"{float(p)!r}D" for p in probs) + ")"
        values = long_values(df, small, by)
        if by and sizes:
            values = _of_cells(values, keys, sizes, "left_anti")
        counted = values.groupBy(*[col(k) for k in keys], "value").agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            counted.groupBy(*[col(k) for k in keys]).agg(
                F.sum("n").alias("n"), F.expr(f"percentile(value, {array}, n)").alias("q")
            )
        )
    if sizes:
        long = long_values(df, [c for c in columns if any(k[-1] == c for k in sizes)], by)
        if by:
            long = _of_cells(long, keys, sizes, "left_semi")
        found = select_ranks(
            long, keys, lambda _, n: [f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)], sizes
        )
        schema = T.StructType(
            [T.StructField(k, long.schema[k].dataType) for k in keys]
            + [T.StructField("n", T.LongType()), T.StructField("q", T.ArrayType(T.DoubleType()))]
        )
        rows = [(*key, n, _interpolated(n, at, probs)) for key, (n, at) in found.items()]
        parts.append(df.sparkSession.createDataFrame(rows, schema))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    map_limit: int = MAP_LIMIT,
    facts: Facts | None = None,
) -> dict[str, list[float]]:
    """column -> quantiles of the whole table, as constants for later expressions."""
    if not columns:
        return {}
    rows = exact_quantiles(df, columns, probs, map_limit=map_limit, facts=facts).collect()
    return {r["column"]: list(r["q"]) for r in rows}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Most frequent number per column, the smallest one on a tie."""
    if not columns:
        return {}
    best = value_counts(df, columns).groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("m"), F.col("value").alias("v"))).alias("b")
    )
    return {r["column"]: r["b"]["v"] for r in best.collect()}


def global_rank(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    name: str = "rank",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Number all rows 1..n by ``order`` (pairs of column and descending).

    A table that fits one task is numbered by one window.  A larger one is
    range-partitioned on the whole order (so equal scores are split by the
    later columns), numbered inside each partition, and shifted by the rows
    before it.  The sorted table is staged once, because the partition borders
    come from a sample and must not change between the two reads.
    """
    n = df.count()
    if n <= rows_per_task:
        w = Window.orderBy(*[col(c).desc() if d else col(c).asc() for c, d in order])
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    parts = math.ceil(n / rows_per_task)
    sort = [col(c).desc() if d else col(c).asc() for c, d in order]
    numbered = (
        df.repartitionByRange(parts, *sort)
        .sortWithinPartitions(*sort)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    numbered = stage(numbered, "rank")
    part = F.shiftright("_at", 33).cast("int")
    # one row per partition
    sizes = {r["_p"]: r["n"] for r in numbered.groupBy(part.alias("_p")).count().withColumnRenamed("count", "n").collect()}
    rows, run = [], 0
    for p in sorted(sizes):
        rows.append((p, run))
        run += sizes[p]
    offsets = df.sparkSession.createDataFrame(rows, "_p int, _before bigint")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.withColumn("_p", part)
        .join(F.broadcast(offsets), "_p")
        .withColumn(name, F.col("_before") + inside + 1)
        .drop("_at", "_p", "_before")
    )
