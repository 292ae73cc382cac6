"""Linear scores and what each feature adds to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.expr import col, number


def linear_margin(coefficients: Mapping[str, float], intercept: float = 0.0, fill: float = 0.0) -> Column:
    """intercept + sum of coefficient * value; missing values take ``fill``."""
    terms = [F.coalesce(number(col(c)), F.lit(fill)) * F.lit(w) for c, w in coefficients.items()]
    return reduce(lambda a, b: a + b, terms, F.lit(float(intercept)))


def logistic_score(df: DataFrame, coefficients: Mapping[str, float], intercept: float = 0.0, name: str = "risk") -> DataFrame:
    """Add the probability of a linear model."""
    return df.withColumn(name, 1 / (1 + F.exp(-linear_margin(coefficients, intercept))))


def feature_means(df: DataFrame, coefficients: Mapping[str, float], fill: float = 0.0) -> dict[str, float]:
    row = df.agg(
        *[F.avg(F.coalesce(number(col(c)), F.lit(fill))).alias(f"m{i}") for i, c in enumerate(coefficients)]
    ).first()
    return {c: row[f"m{i}"] for i, c in enumerate(coefficients)}


def linear_contributions(
    df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float] | None = None, fill: float = 0.0
) -> DataFrame:
    """Add ``contributions``: coefficient * (value - mean) per feature.

    These are the exact Shapley values of a linear model with independent
    features; they add up to the row's margin less the mean margin.
    """
    means = means or feature_means(df, coefficients, fill)
    parts = []
    for c, w in coefficients.items():
        x = F.coalesce(number(col(c)), F.lit(fill))
        parts.append(
            F.struct(
                F.lit(c).alias("feature"), x.alias("value"), ((x - F.lit(means[c])) * F.lit(w)).alias("contribution")
            )
        )
    return df.withColumn("contributions", F.array(*parts))


def vector_contributions(
    df: DataFrame, values: Column, features: Sequence[str], weights: Sequence[float], means: Sequence[float]
) -> DataFrame:
    """Add ``contributions`` of the array ``values``, which holds what the model itself was given.

    With the means of the training rows they add up to the row's margin less the margin at these means, which is the
    mean margin of the training rows.
    """
    parts = [
        F.struct(
            F.lit(f).alias("feature"),
            values[i].alias("value"),
            ((values[i] - F.lit(float(m))) * F.lit(float(w))).alias("contribution"),
        )
        for i, (f, w, m) in enumerate(zip(features, weights, means))
    ]
    return df.withColumn("contributions", F.array(*parts))


def top_drivers(df: DataFrame, k: int = 5) -> DataFrame:
    """Add ``top_drivers``: the k contributions of largest size, ties by feature name."""
    sortable = F.transform(
        "contributions",
        lambda s: F.struct(
            (-F.abs(s["contribution"])).alias("o"),
            s["feature"].alias("feature"),
            s["value"].alias("value"),
            s["contribution"].alias("contribution"),
        ),
    )
    best = F.transform(
        F.slice(F.array_sort(sortable), 1, k),
        lambda s: F.struct(
            s["feature"].alias("feature"), s["value"].alias("value"), s["contribution"].alias("contribution")
        ),
    )
    return df.withColumn("top_drivers", best)


def global_drivers(df: DataFrame, features: Mapping[str, float], k: int = 10) -> DataFrame:
    """(rank, feature, mean_abs, bar_share): mean size of each feature's contribution.

    The contribution array has one place per feature, so its places are averaged
    side by side without unfolding the rows.
    """
    means = df.agg(
        *[F.avg(F.abs(F.col("contributions")[i]["contribution"])).alias(f"a{i}") for i, _ in enumerate(features)]
    )
    rows = F.array(
        *[F.struct((-F.col(f"a{i}")).alias("o"), F.lit(c).alias("f")) for i, c in enumerate(features)]
    )
    # one entry per feature
    best = means.select(F.posexplode(F.slice(F.array_sort(rows), 1, k)).alias("i", "s"), F.array_min(rows)["o"].alias("t"))
    return best.select(
        (F.col("i") + 1).alias("rank"),
        F.col("s.f").alias("feature"),
        (-F.col("s.o")).alias("mean_abs"),
        F.coalesce(F.try_divide(F.col("s.o"), F.col("t")), F.lit(0.0)).alias("bar_share"),
    )
