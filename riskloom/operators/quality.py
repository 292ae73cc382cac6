"""Structural checks, outcome shares and integrity audits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskloom.operators.drift import with_total
from riskloom.functions.expr import col, pct
from riskloom.plans.rules import SEVERITIES, Check


def _plain_zero(df: DataFrame, name: str) -> Column:
    """Negative zero as zero, so that rows that compare equal also hash alike."""
    fraction = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return F.when(col(name) == 0, F.lit(0.0)).otherwise(col(name)) if fraction else col(name)


def _row_digest(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """128 bits that stand for a row: two hashes with seeds of their own.

    The hash passes over NULLs, so which cells are NULL is hashed, too.
    """
    cells = [_plain_zero(df, c) for c in names]
    gaps = [col(c).isNull() for c in names]
    return [F.xxhash64(F.lit(1), *cells, *gaps).alias("_h1"), F.xxhash64(F.lit(2), *gaps, *cells).alias("_h2")]


def repeated_rows(df: DataFrame) -> DataFrame:
    """(all columns, _n) of the rows that occur more than once; NULLs count as equal.

    Whole rows are compared, but only those whose digest recurs; a row with very many copies is one record per task.
    The digests that recur meet the rows in a semi join, whose kind Spark picks by their measured size.
    """
    marked = df.select("*", *_row_digest(df, df.columns))
    recurring = marked.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    rows = marked.join(recurring, ["_h1", "_h2"], "left_semi")
    return rows.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)


def basic_check(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, columns, missing cells and repeated rows, for the table or per group.

    One pass: the rows of a group are counted by digest, and counts and gaps ride along.  Rows of equal digest are
    taken for equal; NULLs count as equal.  What is shuffled is a record per distinct row and task, without its cells.
    """
    cells = [c for c in df.columns if c not in by]
    keys = [col(b) for b in by]
    nulls = reduce(lambda a, b: a + b, [col(c).isNull().cast("bigint") for c in cells])
    rows = df.select(*keys, nulls.alias("_gaps"), *_row_digest(df, cells))
    distinct = rows.groupBy(*keys, "_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"), F.sum("_gaps").alias("_gaps"))
    zero = F.lit(0).cast("bigint")
    sums = distinct.groupBy(*keys).agg(
        F.coalesce(F.sum("_n"), zero).alias("rows"),
        F.coalesce(F.sum("_gaps"), zero).alias("missing_cells"),
        F.coalesce(F.sum(F.col("_n") - 1), zero).alias("duplicate_rows"),
        F.lit(len(cells)).alias("cols"),
    )
    return sums.select(
        *keys,
        "rows",
        "cols",
        "missing_cells",
        pct(F.col("missing_cells"), F.col("rows") * F.col("cols")).alias("missing_cell_pct"),
        "duplicate_rows",
        F.when(F.col("missing_cells") > 0, "Yes").otherwise("No").alias("has_missing"),
        F.when(F.col("duplicate_rows") > 0, "Yes").otherwise("No").alias("has_duplicates"),
    )


def outcome_distribution(df: DataFrame, target: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., target, count, pct) with missing outcomes as a group of their own."""
    counts = df.groupBy(*[col(b) for b in by], col(target)).agg(F.count(F.lit(1)).alias("count"))
    if by:
        total = F.sum("count").over(Window.partitionBy(*[col(b) for b in by]))
        return counts.withColumn("pct", pct(F.col("count"), total))
    return with_total(counts, "count").withColumn("pct", pct(F.col("count"), F.col("_total"))).drop("_total")


def integrity_audit(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """(by..., check_name, severity, severity_rank, affected_rows, details) of the checks with hits.

    All checks share one pass.  Checks whose columns are absent are left out.
    """
    usable = [c for c in checks if all(n in df.columns for n in c.needs)]
    if not usable:
        return df.sparkSession.createDataFrame(
            [], "check_name string, severity string, severity_rank int, affected_rows bigint, details string"
        )
    hits = df.groupBy(*[col(b) for b in by]).agg(
        *[F.count_if(c.hit).alias(f"_h{i}") for i, c in enumerate(usable)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.lit(c.severity).alias("severity"),
                F.lit(SEVERITIES.index(c.severity)).alias("severity_rank"),
                F.col(f"_h{i}").alias("affected_rows"),
                F.lit(c.details).alias("details"),
            )
            for i, c in enumerate(usable)
        ]
    )
    return hits.select(*[col(b) for b in by], F.inline(rows)).where(F.col("affected_rows") > 0)


def by_severity(audit: DataFrame) -> DataFrame:
    """Audit rows with the most severe first."""
    return audit.orderBy("severity_rank", F.desc("affected_rows"), "check_name")
