"""How an outcome varies with other columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.expr import col, mapped, pct
from riskloom.operators.orderstats import exact_quantiles, long_values, value_counts
from riskloom.operators.profile import describe
from riskloom.plans.rules import CONTINUOUS, COUNT

UNKNOWN = "Unknown"
BOX_LIMIT = 10_000


def outcome_label(target: Column, labels: Mapping[str, str]) -> Column:
    """Outcome code or word as label; whatever is not listed is ``Unknown``."""
    return mapped(target.cast("string"), labels, F.lit(UNKNOWN))


def value_label(c: Column, labels: Mapping) -> Column:
    """Code as label; unlisted codes stay as they are."""
    return mapped(c.cast("string"), {str(k): v for k, v in labels.items()}, c.cast("string"))


def crosstabs_pct(df: DataFrame, columns: Sequence[str], target: str, classes: Sequence[str]) -> DataFrame:
    """(column, value, one column per class): share of each outcome per value, in percent of the row.

    All columns share one pass.  Rows lacking either side are dropped; the class
    list makes absent outcomes 0.
    """
    wide = df.where(col(target).isNotNull()).select(
        col(target).alias("_t"), *[col(c).cast("string").alias(c) for c in columns]
    )
    counts = (
        wide.unpivot([F.col("_t")], [col(c) for c in columns], "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(
            F.count(F.lit(1)).alias("_all"),
            *[F.count_if(F.col("_t") == k).alias(f"_n{i}") for i, k in enumerate(classes)],
        )
    )
    return counts.select("column", "value", *[pct(F.col(f"_n{i}"), F.col("_all")).alias(k) for i, k in enumerate(classes)])


def crosstab_pct(df: DataFrame, column: str, target: str, classes: Sequence[str]) -> DataFrame:
    """(value, one column per class) of a single column."""
    return crosstabs_pct(df, [column], target, classes).drop("column")


def grouped_describe(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Description of each column per outcome."""
    return describe(df, columns, [target])


def box_stats(df: DataFrame, columns: Sequence[str], target: str, whisker: float = 1.5) -> DataFrame:
    """(target, column, n, q1, median, q3, whisker_low, whisker_high, fliers).

    Whiskers end at the outermost values within ``whisker`` quartile ranges of
    the box.  With few boxes the rows are compared with a broadcast copy of
    them and nothing is shuffled but the results; with very many, rows and
    boxes are joined on outcome and column, equal values counted first.
    """
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], [target]).where(col(target).isNotNull())
    boxes = q.select(
        col(target).alias("_t"),
        F.col("column").alias("_c"),
        "n",
        *[F.col("q")[i].alias(a) for i, a in enumerate(("q1", "median", "q3"))],
    )
    known = df.where(col(target).isNotNull())
    few = boxes.limit(BOX_LIMIT + 1).collect()
    if len(few) <= BOX_LIMIT:
        boxes = F.broadcast(df.sparkSession.createDataFrame(few, boxes.schema))
        values = long_values(known, columns, [target]).withColumn("k", F.lit(1).cast("bigint"))
    else:
        values = value_counts(known, columns, [target]).withColumnRenamed("n", "k")
    reach = (F.col("q3") - F.col("q1")) * whisker
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        values.join(boxes, (col(target) == F.col("_t")) & (F.col("column") == F.col("_c")))
        .groupBy(col(target), "column", "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("k"))).alias("fliers"),
        )
    )


def target_slices(
    df: DataFrame, columns: Sequence[str], target: str, classes: Sequence[str], kinds: Mapping[str, str]
) -> tuple[DataFrame | None, DataFrame | None]:
    """Outcome shares of the categorical columns, and descriptions per outcome of the numeric ones."""
    present = [c for c in columns if c in df.columns]
    numbers = [c for c in present if kinds[c] in (CONTINUOUS, COUNT)]
    codes = [c for c in present if c not in numbers]
    return (
        crosstabs_pct(df, codes, target, classes) if codes else None,
        grouped_describe(df, numbers, target) if numbers else None,
    )
