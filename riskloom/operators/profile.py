"""Column profiles: shares, descriptions, frequent values, histograms, curves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.functions.expr import col, mapped, number, pct
from riskloom.operators.orderstats import exact_quantiles, long_values
from riskloom.session import stage

BINS = 30
TRACKED = 4096  # values that a summary of frequent values keeps


def binary_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, share_1_pct over known values, all_0_pct and all_1_pct over all rows)."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        x = number(col(c))
        aggs += [
            F.avg(x).alias(f"a{i}"),
            F.count_if(x == 0).alias(f"z{i}"),
            F.count_if(x == 1).alias(f"o{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                (F.col(f"a{i}") * 100).alias("share_1_pct"),
                pct(F.col(f"z{i}"), F.col("_rows")).alias("all_0_pct"),
                pct(F.col(f"o{i}"), F.col("_rows")).alias("all_1_pct"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows)).orderBy(F.desc("share_1_pct"), "column")


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, count, mean, std, min, q25, q50, q75, max), with exact quartiles."""
    keys = [*by, "column"]
    moments = (
        long_values(df, columns, by)
        .groupBy(*[col(k) for k in keys])
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by)
    on = None
    left, right = moments.alias("m"), quartiles.alias("q")
    for k in keys:
        same = F.col(f"m.`{k}`").eqNullSafe(F.col(f"q.`{k}`"))
        on = same if on is None else on & same
    return left.join(right, on).select(
        *[F.col(f"m.`{k}`").alias(k) for k in keys],
        "m.count",
        "m.mean",
        "m.std",
        "m.min",
        *[F.col("q.q")[i].alias(f"q{p}") for i, p in enumerate((25, 50, 75))],
        "m.max",
    )


def top_values(
    df: DataFrame, columns: Sequence[str], k: int = 10, labels: Mapping[str, Mapping] | None = None
) -> DataFrame:
    """(column, value, count, pct, rank): the k most frequent values, missing included.

    Ties go to the smaller value.  The rank limit is applied before the shuffle
    of the ranking, so a column with many values does not meet in one task.
    """
    labels = labels or {}
    wide = df.select(
        *[
            mapped(col(c).cast("string"), {str(a): b for a, b in labels[c].items()}, col(c).cast("string")).alias(c)
            if c in labels
            else col(c).cast("string").alias(c)
            for c in columns
        ]
    )
    counts = (
        wide.unpivot([], [col(c) for c in columns], "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    order = Window.partitionBy("column").orderBy(F.desc("count"), F.asc_nulls_last("value"))
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    rows = df.count()
    return best.withColumn("pct", F.col("count") * F.lit(100.0 / max(rows, 1)))


def frequent_values(df: DataFrame, columns: Sequence[str], k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """What ``top_values`` gives, without a shuffle of all distinct values of columns that have k frequent ones.

    One pass over the rows keeps a summary of ``tracked`` values per column and task; a value with more than
    ``7 / tracked`` of the rows (twice the summary's error bound) is named by it for certain.  The named values are
    counted exactly.  A column is done if the k-th of them is above the bound, as none that the summary lost can then
    be ahead of it or equal to it, or if they and the gaps are all of the rows; other columns are counted in full.
    """
    wide = df.select(*[col(c).cast("string").alias(c) for c in columns])
    summaries = [
        F.transform(
            F.expr(f"approx_top_k(`{c.replace('`', '``')}`, {tracked}, {tracked})"), lambda x: F.xxhash64(x["item"])
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]
    # hashes of at most ``tracked`` values a column; a hash that names two values does no harm, both are counted
    facts = wide.agg(F.count(F.lit(1)).alias("n"), *summaries).first()
    n = facts["n"]
    named = df.sparkSession.createDataFrame(
        [(c, h) for i, c in enumerate(columns) for h in facts[f"s{i}"] or []], "column string, _h bigint"
    )
    cells = wide.unpivot([], [col(c) for c in columns], "column", "value").withColumn("_h", F.xxhash64("value"))
    known = cells.where(F.col("value").isNotNull()).join(F.broadcast(named), ["column", "_h"], "left_semi")
    gaps = cells.where(F.col("value").isNull())
    counts = known.unionByName(gaps).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    order = Window.partitionBy("column").orderBy(F.desc("count"), F.asc_nulls_last("value"))
    found = counts.withColumns({"rank": F.row_number().over(order), "_all": F.sum("count").over(Window.partitionBy("column"))})
    best = stage(found.where(F.col("rank") <= k), "frequent")
    last = best.groupBy("column").agg(
        F.max(F.when(F.col("rank") == k, F.col("count"))).alias("least"), F.max("_all").alias("_all")
    )
    # a row per column
    proven = {
        r["column"] for r in last.collect() if r["_all"] == n or (r["least"] is not None and r["least"] * tracked > 7 * n)
    }
    out = best.where(F.col("column").isin(*proven)).drop("_all") if proven else best.drop("_all").limit(0)
    out = out.withColumn("pct", F.col("count") * F.lit(100.0 / max(n, 1)))
    rest = [c for c in columns if c not in proven]
    return out.unionByName(top_values(df, rest, k)) if rest else out


def histogram(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """(column, bin, low, high, n): equal-width bins, the last one closed; empty bins are 0."""
    ends = (
        long_values(df, columns)
        .groupBy("column")
        .agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
        .collect()
    )
    # a column with one value gets a unit range around it
    spans = [(r["column"], *((r["lo"], r["hi"]) if r["hi"] > r["lo"] else (r["lo"] - 0.5, r["hi"] + 0.5))) for r in ends]
    wide = df.select(
        *[
            F.least(
                F.floor((number(col(c)) - lo) / F.lit((hi - lo) / bins)).cast("int"), F.lit(bins - 1)
            ).alias(c)
            for c, lo, hi in spans
        ]
    )
    counts = (
        wide.unpivot([], [col(c) for c, _, _ in spans], "column", "bin")
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = df.sparkSession.createDataFrame(
        [(c, b, lo + b * (hi - lo) / bins, lo + (b + 1) * (hi - lo) / bins) for c, lo, hi in spans for b in range(bins)],
        "column string, bin int, low double, high double",
    )
    return grid.join(counts, ["column", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def ecdf(df: DataFrame, columns: Sequence[str], points: int = 101) -> DataFrame:
    """(column, p, value): the sorted-value curve at evenly spaced positions."""
    probs = [i / (points - 1) for i in range(points)]
    grid = F.array(*[F.lit(p) for p in probs])
    return exact_quantiles(df, columns, probs).select(
        "column", F.inline(F.arrays_zip(grid.alias("p"), F.col("q").alias("value")))
    )
