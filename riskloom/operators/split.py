"""Repeatable stratified splits, folds and class weights.

A split takes the rows with the smallest hash per class.  Instead of ranking
a large class in one task, the hash value at the wanted rank is found exactly
(see ``orderstats``) and rows are compared with it, so no row moves.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from riskloom.functions.expr import col
from riskloom.operators.orderstats import ROWS_PER_TASK, select_ranks

HASH_RANGE = 1 << 53


def hash_order(key: str, seed: int = 42) -> Column:
    """Evenly spread, repeatable order of the keys, exact as a double."""
    return F.pmod(F.xxhash64(F.lit(seed), col(key)), F.lit(HASH_RANGE)).cast("double")


def _cut_table(
    ordered: DataFrame, label: str, ranks: Callable[[int], Sequence[int]], rows_per_task: int
) -> tuple[DataFrame, bool, bool]:
    """(label, cuts) of the classes too large for one task, and whether there are large and small ones."""
    sizes = ordered.groupBy(col(label).alias("_label")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_o").alias("lo"), F.max("_o").alias("hi")
    )
    large_one = F.when(F.col("n") > rows_per_task, F.struct("_label", "n", "lo", "hi"))
    # the list holds at most one entry per ``rows_per_task`` rows of the table
    row = sizes.agg(F.collect_list(large_one).alias("large"), F.count(F.lit(1)).alias("classes")).first()
    large = {(r["_label"],): (r["n"], r["lo"], r["hi"]) for r in row["large"]}
    some_small = row["classes"] > len(large)
    schema = T.StructType(
        [
            T.StructField("_label", ordered.schema[label].dataType),
            T.StructField("_cuts", T.ArrayType(T.DoubleType())),
        ]
    )
    spark = ordered.sparkSession
    if not large:
        return spark.createDataFrame([], schema), False, some_small
    names = F.broadcast(spark.createDataFrame(list(large), T.StructType([schema["_label"]])))
    long = ordered.join(names, col(label).eqNullSafe(F.col("_label"))).select(
        "_label", F.col("_o").alias("value")
    )
    found = select_ranks(long, ["_label"], lambda _, n: [r for r in ranks(n) if r >= 0], large)
    # rank -1 (take nothing) lies below every order value
    rows = [(key[0], [at[r] if r >= 0 else float("-inf") for r in ranks(n)]) for key, (n, at) in found.items()]
    return spark.createDataFrame(rows, schema), True, some_small


def _placed(
    df: DataFrame,
    label: str,
    key: str,
    order: Column,
    ranks: Callable[[int], Sequence[int]],
    by_cuts: Column,
    by_window: Callable[[WindowSpec, Column], Column],
    name: str,
    rows_per_task: int,
) -> DataFrame:
    """Large classes are placed by comparing with their cuts, small ones by a window over the class."""
    ordered = df.withColumn("_o", order.cast("double"))
    cuts, some_large, some_small = _cut_table(ordered, label, ranks, rows_per_task)
    parts = []
    if some_large:
        joined = ordered.join(F.broadcast(cuts), col(label).eqNullSafe(F.col("_label")))
        parts.append(joined.withColumn(name, by_cuts).drop("_label", "_cuts"))
    if some_small or not some_large:
        rest = ordered
        if some_large:
            rest = ordered.join(F.broadcast(cuts), col(label).eqNullSafe(F.col("_label")), "left_anti")
        group = Window.partitionBy(col(label))
        parts.append(
            rest.withColumn(name, by_window(group.orderBy("_o", col(key)), F.count(F.lit(1)).over(group)))
        )
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.drop("_o")


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    share: float = 0.2,
    order: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``split`` (test/train) with round(share * n) test rows in every class.

    ``key`` must be unique; ``order`` replaces the hash order and must be unique too.
    """
    return _placed(
        df,
        label,
        key,
        hash_order(key) if order is None else order,
        lambda n: [math.floor(share * n + 0.5) - 1],
        F.when(F.col("_o") <= F.col("_cuts")[0], "test").otherwise("train"),
        lambda w, n: F.when(F.row_number().over(w) <= F.floor(n * share + 0.5), "test").otherwise("train"),
        "split",
        rows_per_task,
    )


def stratified_folds(
    df: DataFrame,
    label: str,
    key: str,
    k: int = 5,
    order: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``fold`` (1..k), of equal size per class; the first folds take the remainder."""

    def ranks(n: int) -> list[int]:
        size, extra = divmod(n, k)
        return [size * i + min(i, extra) - 1 for i in range(1, k)]

    return _placed(
        df,
        label,
        key,
        hash_order(key, 7) if order is None else order,
        ranks,
        F.size(F.filter("_cuts", lambda c: F.col("_o") > c)) + 1,
        lambda w, _: F.ntile(k).over(w),
        "fold",
        rows_per_task,
    )


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.where(col(label).isNotNull()).groupBy(col(label)).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str) -> dict:
    """class -> n / (number of classes * class size); one number per class."""
    counts = {r[0]: r[1] for r in class_counts(df, label).collect()}
    total = sum(counts.values())
    return {k: total / (len(counts) * n) for k, n in counts.items()}


def with_weights(df: DataFrame, label: str, name: str = "weight", weights: Mapping | None = None) -> DataFrame:
    weights = weights or class_weights(df, label)
    out = None
    for k, w in sorted(weights.items()):
        hit = col(label) == k
        out = F.when(hit, F.lit(w)) if out is None else out.when(hit, F.lit(w))
    return df.withColumn(name, out if out is not None else F.lit(None).cast("double"))
