"""From raw batches to a clean table with its reports."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.functions.expr import col, number, pct
from riskloom.operators import drift, missing, outliers, quality
from riskloom.operators.orderstats import column_facts
from riskloom.operators.schema import classify_columns, group_by_kind
from riskloom.plans.rules import CONTINUOUS, COUNT, Check, RuleSet
from riskloom.session import stage


@dataclass(frozen=True)
class Cleaned:
    table: DataFrame
    kinds: Mapping[str, str]
    missing_plan: DataFrame
    outlier_report: DataFrame


def clip_negatives(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Set negative values of the named columns to 0."""
    new = {}
    for c in columns:
        if c in df.columns:
            x = number(col(c))
            new[c] = F.when(x < 0, F.lit(0.0)).otherwise(x)
    return df.withColumns(new) if new else df


def clean(
    df: DataFrame,
    rules: RuleSet,
    keys: Sequence[str] = (),
    clip: Sequence[str] = (),
    multiple: float = 3.0,
) -> Cleaned:
    """Clip, fill and flag.

    The filled table is staged, because the outlier steps read it several
    times; facts and fences are found once and shared, and the plan and the
    report are kept as rows.
    """
    clipped = clip_negatives(df, clip)
    data = [c for c in clipped.columns if c not in keys]
    kinds = classify_columns(clipped, rules, exclude=keys)
    plan = _kept(missing.missing_plan(clipped.select(*[col(c) for c in data]), rules, kinds))
    filled = stage(missing.apply_plan(clipped, plan), "filled")
    groups = group_by_kind({c: k for c, k in kinds.items() if c != rules.target})
    numbers = groups[CONTINUOUS] + groups[COUNT]
    open_ended = outliers.unbounded(numbers)
    facts = column_facts(filled, open_ended) if open_ended else None
    fences = outliers.iqr_fences(filled, open_ended, multiple, facts)
    report = _kept(
        outliers.outlier_report(filled, open_ended, rules, multiple, fences=fences, facts=facts)
    )
    return Cleaned(outliers.apply_outliers(filled, report, multiple, fences, facts), kinds, plan, report)


def _kept(df: DataFrame) -> DataFrame:
    """A table of one row per column, worked out once."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def segment_panels(
    df: DataFrame,
    batch: str,
    target: str,
    checks: Sequence[Check] = (),
    top_missing: int = 5,
    measures: Sequence[str] = (),
) -> DataFrame:
    """(segment, block, item, metric, value): the intake panel of every batch and of all batches together.

    Blocks: ``basic``, ``dtype``, ``missing`` (the ``top_missing`` columns with most gaps), ``outcome``,
    ``drift_last``, ``drift_cum``, ``outlier`` (the named ``measures`` against fences of all batches), ``audit``,
    and ``severity``, which adds up the audit.
    """
    cells = df.drop(batch)
    basics = quality.basic_check(df, [batch]).withColumnRenamed(batch, "segment").unionByName(
        quality.basic_check(cells).withColumn("segment", F.lit("Overall"))
    )
    parts = [
        _long(basics, "segment", "basic", F.lit("all"), ["rows", "cols", "missing_cells", "missing_cell_pct", "duplicate_rows"])
    ]
    # one row per segment; unfolded to a row per type and per column
    types = F.array(
        *[
            F.struct(F.lit(t).alias("item"), F.lit(float(n)).alias("columns"))
            for t, n in Counter(t for c, t in df.dtypes if c != batch).items()
        ]
    )
    parts.append(
        _long(basics.select("segment", F.inline(types)), "segment", "dtype", F.col("item"), ["columns"])
    )
    gaps = df.groupBy(col(batch)).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cells.columns)]
    )
    gaps = stage(gaps.withColumnRenamed(batch, "segment"), "gaps")
    whole = gaps.agg(*[F.sum(c).alias(c) for c in gaps.columns if c != "segment"]).withColumn("segment", F.lit("Overall"))
    each = F.array(
        *[
            F.struct((-F.col(f"_m{i}")).alias("_o"), F.lit(c).alias("item"), F.col(f"_m{i}").alias("missing_count"))
            for i, c in enumerate(cells.columns)
        ]
    )
    worst = F.slice(F.array_sort(F.filter(each, lambda x: x["missing_count"] > 0)), 1, top_missing)
    missed = gaps.unionByName(whole).select("segment", "_n", F.inline(worst))
    missed = missed.withColumn("missing_pct", pct(F.col("missing_count"), F.col("_n")))
    parts.append(_long(missed, "segment", "missing", F.col("item"), ["missing_count", "missing_pct"]))
    # the counts per batch and outcome are few, so the totals are made from them
    counts = drift.batch_counts(df, batch, target)
    both = counts.groupingSets([[batch, target], [target]], batch, target).agg(
        F.sum("n").alias("count"), F.grouping(batch).alias("_all")
    )
    named = both.select(
        F.when(F.col("_all") == 1, "Overall").otherwise(col(batch)).alias("segment"),
        F.coalesce(col(target), F.lit("missing")).alias("item"),
        "count",
    )
    total = F.sum("count").over(Window.partitionBy("segment"))
    parts.append(_long(named.withColumn("pct", pct(F.col("count"), total)), "segment", "outcome", F.col("item"), ["count", "pct"]))
    for block, table, ref in (
        ("drift_last", drift.drift_vs_previous(df, batch, target, counts), "last_pct"),
        ("drift_cum", drift.drift_vs_cumulative(df, batch, target, counts), "cum_pct"),
    ):
        parts.append(_long(table, batch, block, col(target), ["this_pct", ref, "delta_pct"]))
    if measures:
        beyond = outliers.outlier_counts(df, measures, batch)
        parts.append(_long(beyond, "segment", "outlier", F.col("column"), ["outlier_count", "outlier_pct"]))
    if checks:
        # hits add up over the batches
        per = stage(quality.integrity_audit(df, checks, [batch]).withColumnRenamed(batch, "segment"), "audit")
        named = [c for c in per.columns if c not in ("segment", "affected_rows")]
        whole = per.groupBy(*named).agg(F.sum("affected_rows").alias("affected_rows"))
        audits = per.unionByName(whole.withColumn("segment", F.lit("Overall")))
        parts.append(_long(audits, "segment", "audit", F.col("check_name"), ["affected_rows", "severity_rank"]))
        levels = audits.groupBy("segment", "severity").agg(
            F.count(F.lit(1)).alias("checks"), F.sum("affected_rows").alias("affected_rows")
        )
        parts.append(_long(levels, "segment", "severity", F.col("severity"), ["checks", "affected_rows"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _long(df: DataFrame, segment: str, block: str, item, metrics: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), col(m).cast("double").alias("value")) for m in metrics])
    return df.select(col(segment).alias("segment"), F.lit(block).alias("block"), item.alias("item"), F.inline(pairs))
