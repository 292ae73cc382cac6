"""Outcome drift between batches, in percentage points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.functions.expr import col, pct
from riskloom.session import stage


def shares(df: DataFrame, target: str) -> DataFrame:
    """(target, pct) over the rows with a known outcome."""
    counts = df.where(col(target).isNotNull()).groupBy(col(target)).agg(F.count(F.lit(1)).alias("n"))
    return with_total(counts, "n").select(col(target), pct(F.col("n"), F.col("_total")).alias("pct"))


def with_total(counts: DataFrame, n: str) -> DataFrame:
    """Add ``_total``, the sum of ``n`` over all rows: one number, looked up first and used as a literal."""
    total = counts.agg(F.sum(n)).first()[0]
    return counts.withColumn("_total", F.lit(total).cast("bigint"))


def compare_shares(this: DataFrame, ref: DataFrame, target: str, ref_name: str = "ref") -> DataFrame:
    """Shares of two tables side by side; a value absent from one has share 0 there."""
    a = shares(this, target).withColumnRenamed("pct", "this_pct")
    b = shares(ref, target).withColumnRenamed("pct", f"{ref_name}_pct")
    both = a.join(b, target, "full_outer").fillna(0.0, ["this_pct", f"{ref_name}_pct"])
    return both.withColumn("delta_pct", F.col("this_pct") - F.col(f"{ref_name}_pct"))


def batch_counts(df: DataFrame, batch: str, target: str) -> DataFrame:
    """(batch, target, n), staged: the only pass over the rows that drift needs."""
    counts = df.groupBy(col(batch), col(target)).agg(F.count(F.lit(1)).alias("n"))
    return stage(counts, "counts")


def _numbered(counts: DataFrame, batch: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Counts of known outcomes with their batch number, and one row per batch with its totals."""
    known = counts.where(col(target).isNotNull())
    # a handful of rows: one per batch, in time order
    order = Window.partitionBy(F.lit(1)).orderBy(col(batch))
    batches = (
        known.groupBy(col(batch))
        .agg(F.sum("n").alias("total"))
        .select(
            col(batch),
            "total",
            F.row_number().over(order).alias("no"),
            F.sum("total").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("prior_total"),
            F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))).cast("int").alias("last_no"),
        )
    )
    return known.join(batches, batch), batches


def drift_vs_previous(df: DataFrame, batch: str, target: str, counts: DataFrame | None = None) -> DataFrame:
    """(batch, target, this_pct, last_pct, delta_pct) for every batch but the first.

    A row appears for each value of either batch, like the full outer join of
    the two share tables.  ``counts`` may hold ``batch_counts`` already made.
    """
    counts, batches = _numbered(counts or batch_counts(df, batch, target), batch, target)
    now = counts.select("no", col(target), pct(F.col("n"), F.col("total")).alias("this_pct"))
    before = now.select((F.col("no") + 1).alias("no"), col(target), F.col("this_pct").alias("last_pct"))
    return (
        now.join(before, ["no", target], "full_outer")
        .join(batches.where("no > 1").select(col(batch), "no"), "no")
        .select(
            col(batch),
            col(target),
            F.coalesce("this_pct", F.lit(0.0)).alias("this_pct"),
            F.coalesce("last_pct", F.lit(0.0)).alias("last_pct"),
        )
        .withColumn("delta_pct", F.col("this_pct") - F.col("last_pct"))
    )


def drift_vs_cumulative(df: DataFrame, batch: str, target: str, counts: DataFrame | None = None) -> DataFrame:
    """(batch, target, this_pct, cum_pct, delta_pct) against all earlier batches together."""
    counts, batches = _numbered(counts or batch_counts(df, batch, target), batch, target)
    # each value from the batch it first occurs in up to the last one
    grid = (
        counts.groupBy(col(target))
        .agg(F.min("no").alias("first"), F.max("last_no").alias("last"))
        .select(col(target), F.explode(F.sequence("first", "last")).alias("no"))
    )
    before = (
        Window.partitionBy(col(target)).orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        grid.join(counts.select("no", col(target), "n"), ["no", target], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("prior", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(batches.where("no > 1"), "no")
        .select(
            col(batch),
            col(target),
            pct(F.col("n"), F.col("total")).alias("this_pct"),
            pct(F.col("prior"), F.col("prior_total")).alias("cum_pct"),
        )
        .withColumn("delta_pct", F.col("this_pct") - F.col("cum_pct"))
    )


def period_change(df: DataFrame, period: str, value: str, floor: float, consecutive: int = 1) -> DataFrame:
    """Per period: mean value, change against the period before, and an alert below ``floor``.

    ``consecutive`` asks for that many low periods in a row before alerting.
    """
    # one row per period after the aggregation
    order = Window.partitionBy(F.lit(1)).orderBy(period)
    means = df.groupBy(col(period)).agg(F.avg(col(value)).alias("score"), F.count(F.lit(1)).alias("n"))
    low = (F.col("score") < floor).cast("int")
    run = F.sum(low).over(order.rowsBetween(1 - consecutive, 0))
    return means.select(
        col(period),
        "n",
        "score",
        (F.col("score") - F.lag("score").over(order)).alias("change"),
        F.coalesce((run == consecutive).cast("int"), F.lit(0)).alias("alert"),
    )
