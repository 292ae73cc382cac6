"""Pairwise-complete Pearson correlations.

One pass finds count, mean and deviation of every column.  The second adds up
Gram matrices of the standardised columns and of their masks of known values,
block by block inside the tasks: from the four of them follow the sums of every
pair over its common rows, however many columns have gaps.  Standardising first
keeps the sums well conditioned.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from riskloom.operators.orderstats import numeric_view
from riskloom.operators.schema import numeric_columns
from riskloom.operators.sums import matrix_sums

FLAT = 1e-12


def _pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(a, b, r) for the listed pairs; r is NULL where either side is constant or holds an infinite value.

    Two passes over the rows, however many columns; only the matrices come back.
    """
    names = list(dict.fromkeys(c for p in pairs for c in p))
    at = {c: i for i, c in enumerate(names)}
    x = numeric_view(df, names, names=[f"x{i}" for i in range(len(names))])
    moments = []
    for i in range(len(names)):
        v = F.col(f"x{i}")
        finite = F.when(F.abs(v) < float("inf"), v)
        moments += [
            F.count(v).alias(f"n{i}"),
            F.avg(finite).alias(f"m{i}"),
            F.stddev_pop(finite).alias(f"s{i}"),
            F.count_if(F.abs(v) == float("inf")).alias(f"i{i}"),
        ]
    row = x.agg(F.count(F.lit(1)).alias("n"), *moments).first()
    # a column with an infinite value has no correlation
    spread = [c for c in names if row[f"s{at[c]}"] and not row[f"i{at[c]}"]]
    means, scales = (np.array([row[f"{k}{at[c]}"] for c in spread], float) for k in "ms")
    place = {c: i for i, c in enumerate(spread)}

    def gram(block: np.ndarray) -> list[np.ndarray]:
        known = ~np.isnan(block)
        z = np.where(known, (block - means) / scales, 0.0)
        known = known.astype(float)
        return [z.T @ z, known.T @ known, z.T @ known, (z * z).T @ known]

    sums = matrix_sums(x, [F.col(f"x{at[c]}") for c in spread], gram) if spread else None

    def found(a: str, b: str) -> float | None:
        if a not in place or b not in place:
            return None
        if a == b:
            return 1.0
        i, j = place[a], place[b]
        products, common, first, squares = sums
        own = (products[i, j], common[i, j], first[i, j], first[j, i], squares[i, j], squares[j, i])
        return _from_sums([float(v) for v in own])

    rows = [(a, b, found(a, b)) for a, b in pairs]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def _from_sums(sums: Sequence[float]) -> float | None:
    xy, n, sx, sy, xx, yy = sums
    if not n:
        return None
    vx, vy = xx / n - (sx / n) ** 2, yy / n - (sy / n) ** 2
    if vx <= FLAT or vy <= FLAT:
        return None
    return (xy / n - sx * sy / n**2) / math.sqrt(vx * vy)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame | None:
    """(a, b, r) for every ordered pair of the numeric columns among ``columns``; None under two.

    Each pair is computed once, the mirror image is derived from it.
    """
    numeric = set(numeric_columns(df))
    names = [c for c in columns if c in numeric]
    if len(names) < 2:
        return None
    upper = _pairs(df, [(c, c) for c in names] + list(combinations(names, 2)))
    mirrored = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", "r"))).otherwise(
        F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    )
    return upper.select(F.inline(mirrored))


def correlation_with(df: DataFrame, columns: Sequence[str], target: str, k: int = 20) -> DataFrame:
    """(feature, correlation) of the k columns that go most with the target, undefined ones left out."""
    return (
        _pairs(df, [(c, target) for c in columns])
        .where(F.col("r").isNotNull())
        .orderBy(F.desc(F.abs("r")), "a")
        .limit(k)
        .select(F.col("a").alias("feature"), F.col("r").alias("correlation"))
    )
