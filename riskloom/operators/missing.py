"""Missing values: plan, summary, indicators and fills."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.functions.expr import col, number, pct
from riskloom.operators.orderstats import modes, quantile_table
from riskloom.plans.rules import RuleSet

UNKNOWN = "Unknown"


def _null_counts(df: DataFrame, columns: Sequence[str], extra: Mapping[str, Sequence[Column]]) -> DataFrame:
    """One pass over the table, then one row per column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                *extra.get(c, ()),
                F.col(f"_m{i}").alias("missing_count"),
                pct(F.col(f"_m{i}"), F.col("_rows")).alias("missing_pct"),
                (F.col("_rows") - F.col(f"_m{i}")).alias("non_missing_count"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(F.inline(rows))


def missing_summary(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_pct, non_missing_count) of columns with gaps."""
    return (
        _null_counts(df, df.columns, {})
        .where(F.col("missing_count") > 0)
        .orderBy(F.desc("missing_pct"), "column")
    )


def missing_plan(df: DataFrame, rules: RuleSet, kinds: Mapping[str, str] | None = None) -> DataFrame:
    """(column, rule_bucket, missing_count, missing_pct, strategy, rationale), worst column first."""
    kinds = kinds or {}
    extra = {}
    for c in df.columns:
        rule = rules.fill_rule(c, kinds.get(c))
        extra[c] = (
            F.lit(rules.bucket(c)).alias("rule_bucket"),
            F.lit(rule.action).alias("strategy"),
            F.lit(rule.reason).alias("rationale"),
        )
    return (
        _null_counts(df, df.columns, extra)
        .where(F.col("missing_count") > 0)
        .select("column", "rule_bucket", "missing_count", "missing_pct", "strategy", "rationale")
        .orderBy(F.desc("missing_pct"), F.desc("missing_count"), "column")
    )


@dataclass(frozen=True)
class FittedFill:
    """Strategies and fill values found on one table, usable on another."""

    strategies: Mapping[str, str]
    values: Mapping[str, float | None]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``<column>__is_missing`` and fill; every other column is passed on."""
        new: dict[str, Column] = {}
        for c, strategy in self.strategies.items():
            if c not in df.columns:
                continue
            new[f"{c}__is_missing"] = col(c).isNull().cast("int")
            kind = df.schema[c].dataType
            if strategy == "indicator+unknown":
                new[c] = F.coalesce(col(c).cast("string"), F.lit(UNKNOWN))
            elif strategy in ("indicator+median", "indicator+mode"):
                value = self.values.get(c)
                filled = F.coalesce(number(col(c)), F.lit(value).cast("double"))
                whole = isinstance(kind, T.IntegralType) and (value is None or float(value).is_integer())
                new[c] = filled.cast(kind) if whole else filled
            elif strategy in ("indicator+zero", "indicator+assume_no"):
                filled = F.coalesce(number(col(c)), F.lit(0.0))
                new[c] = filled.cast("bigint") if isinstance(kind, T.IntegralType) else filled
        return df.withColumns(new) if new else df


def fit_fill(df: DataFrame, strategies: Mapping[str, str]) -> FittedFill:
    """Find medians and modes of the columns whose strategy needs them."""
    medians = [c for c, s in strategies.items() if s == "indicator+median"]
    typical = [c for c, s in strategies.items() if s == "indicator+mode"]
    values: dict[str, float | None] = dict.fromkeys(medians)
    values.update({c: q[0] for c, q in quantile_table(df, medians, [0.5]).items()})
    values.update({c: 0.0 for c in typical})  # a column without any value
    values.update(modes(df, typical))
    return FittedFill(dict(strategies), values)


def plan_strategies(plan: DataFrame) -> dict[str, str]:
    """The plan as column -> strategy; one row per column with gaps."""
    return {r["column"]: r["strategy"] for r in plan.select("column", "strategy").collect()}


def apply_plan(df: DataFrame, plan: DataFrame) -> DataFrame:
    return fit_fill(df, plan_strategies(plan)).transform(df)
