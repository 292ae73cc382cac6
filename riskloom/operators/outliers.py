"""Outlier fences, reports and winsorising."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.expr import clip, col, flag, number, pct
from riskloom.operators.orderstats import Facts, column_facts, few_distinct, quantile_table
from riskloom.plans.rules import RuleSet

MIN_VALUES = 20
FEW_VALUES = 25


@dataclass(frozen=True)
class Fence:
    """Values outside [low, high] are outliers; no fence means none are."""

    low: float | None
    high: float | None

    def outside(self, c: Column) -> Column:
        if self.low is None:
            return F.lit(False)
        return F.coalesce((c < self.low) | (c > self.high), F.lit(False))


def iqr_fences(
    df: DataFrame, columns: Sequence[str], multiple: float = 3.0, facts: Facts | None = None
) -> dict[str, Fence]:
    """Quartiles widened by ``multiple`` quartile ranges; none under 20 values or without spread."""
    if not columns:
        return {}
    facts = facts or column_facts(df, columns)
    enough = [c for c in columns if facts.known(c) >= MIN_VALUES]
    quartiles = quantile_table(df, enough, [0.25, 0.75], facts=facts)
    out = {}
    for c in columns:
        q1, q3 = quartiles.get(c, (0.0, 0.0))
        spread = q3 - q1
        out[c] = Fence(q1 - multiple * spread, q3 + multiple * spread) if spread > 0 else Fence(None, None)
    return out


def zscore_flags(df: DataFrame, columns: Sequence[str], threshold: float = 4.0) -> DataFrame:
    """``df`` with ``<column>__is_outlier`` where \\|x - mean\\| exceeds ``threshold`` sample deviations."""
    aggs = []
    for i, c in enumerate(columns):
        x = number(col(c))
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    new = {}
    for i, c in enumerate(columns):
        n, mean, sd = row[f"n{i}"], row[f"m{i}"], row[f"s{i}"]
        if n < MIN_VALUES or not sd:
            new[f"{c}__is_outlier"] = F.lit(0)
        else:
            new[f"{c}__is_outlier"] = flag(F.abs((number(col(c)) - mean) / sd) > threshold)
    return df.withColumns(new)


def iqr_flags(
    df: DataFrame, columns: Sequence[str], multiple: float = 3.0, fences: Mapping[str, Fence] | None = None
) -> DataFrame:
    """``df`` with ``<column>__is_outlier`` by quartile fences."""
    fences = fences or iqr_fences(df, columns, multiple)
    return df.withColumns(
        {f"{c}__is_outlier": flag(fences[c].outside(number(col(c)))) for c in columns}
    )


def unbounded(columns: Sequence[str], skip_word: str | None = "grade") -> list[str]:
    """Columns without the word that marks a bounded scale."""
    return [c for c in columns if not (skip_word and skip_word in c.lower())]


def outlier_report(
    df: DataFrame,
    columns: Sequence[str],
    rules: RuleSet | None = None,
    multiple: float = 3.0,
    few_values: int = FEW_VALUES,
    skip_word: str | None = "grade",
    fences: Mapping[str, Fence] | None = None,
    facts: Facts | None = None,
) -> DataFrame:
    """(column, outlier_count, outlier_pct, handling, rationale) of columns with outliers.

    Columns with few distinct values count as codes and are skipped, and so are
    bounded columns, which ``skip_word`` in the name marks.  ``fences`` and
    ``facts`` may be handed in where they are known already.
    """
    rules = rules or RuleSet()
    names = unbounded([c for c in columns if c in df.columns], skip_word)
    facts = facts or (column_facts(df, names) if names else None)
    few = few_distinct(df, names, few_values, facts)
    names = [c for c in names if few[c] is None]
    schema = "column string, outlier_count bigint, outlier_pct double, handling string, rationale string"
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    fences = fences or iqr_fences(df, names, multiple, facts)
    aggs = []
    for i, c in enumerate(names):
        x = number(col(c))
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(fences[c].outside(x)).alias(f"o{i}")]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"o{i}").alias("outlier_count"),
                pct(F.col(f"o{i}"), F.col(f"n{i}")).alias("outlier_pct"),
                F.lit(rules.policy(c).action).alias("handling"),
                F.lit(rules.policy(c).reason).alias("rationale"),
            )
            for i, c in enumerate(names)
        ]
    )
    return (
        df.agg(*aggs)
        .select(F.inline(rows))
        .where(F.col("outlier_count") > 0)
        .orderBy(F.desc("outlier_pct"), "column")
    )


def outlier_counts(
    df: DataFrame,
    columns: Sequence[str],
    batch: str,
    whole: str = "Overall",
    multiple: float = 3.0,
    few_values: int = FEW_VALUES,
    skip_word: str | None = "grade",
) -> DataFrame:
    """(segment, column, outlier_count, outlier_pct) of each batch and of all, where a column has outliers.

    The fences come from all batches, so a count tells how far one batch departs from the rest; columns are
    chosen as in ``outlier_report``.  A missing batch label is a segment of its own.
    """
    names = unbounded([c for c in columns if c in df.columns], skip_word)
    facts = column_facts(df, names) if names else None
    few = few_distinct(df, names, few_values, facts) if names else {}
    names = [c for c in names if few[c] is None]
    if not names:
        return df.sparkSession.createDataFrame(
            [], "segment string, column string, outlier_count bigint, outlier_pct double"
        )
    fences = iqr_fences(df, names, multiple, facts)
    aggs = []
    for i, c in enumerate(names):
        x = number(col(c))
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(fences[c].outside(x)).alias(f"o{i}")]
    per = df.groupBy(col(batch)).agg(*aggs)
    # a row per batch, from which the row of all batches is added up
    sums = [F.sum(c).alias(c) for c in per.columns if c != batch]
    both = per.groupingSets([[batch], []], batch).agg(*sums, F.grouping(batch).alias("_all"))
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"o{i}").alias("outlier_count"),
                pct(F.col(f"o{i}"), F.col(f"n{i}")).alias("outlier_pct"),
            )
            for i, c in enumerate(names)
        ]
    )
    segment = F.when(F.col("_all") == 1, whole).otherwise(col(batch).cast("string")).alias("segment")
    return both.select(segment, F.inline(rows)).where(F.col("outlier_count") > 0)


def winsorize(df: DataFrame, columns: Sequence[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Limit the columns to their lower and upper quantile; missing stays missing."""
    limits = quantile_table(df, columns, [lower, upper])
    return df.withColumns({c: clip(number(col(c)), *limits[c]) for c in columns if c in limits})


def apply_outliers(
    df: DataFrame,
    report: DataFrame,
    multiple: float = 3.0,
    fences: Mapping[str, Fence] | None = None,
    facts: Facts | None = None,
) -> DataFrame:
    """Add indicators for the reported columns and winsorise those whose policy says so."""
    handling = {r["column"]: r["handling"] for r in report.select("column", "handling").collect()}
    handling = {c: h for c, h in handling.items() if c in df.columns}
    if not handling:
        return df
    flagged = iqr_flags(df, list(handling), multiple, fences)
    noisy = [c for c, h in handling.items() if h == "winsorize"]
    limits = quantile_table(df, noisy, [0.01, 0.99], facts=facts)
    if not limits:
        return flagged
    return flagged.withColumns({c: clip(number(col(c)), *q) for c, q in limits.items()})
