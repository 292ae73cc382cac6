"""Report tables: the data behind each page, as tidy DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.expr import col
from riskloom.operators import outcome, profile
from riskloom.operators.schema import group_by_kind
from riskloom.plans.rules import BINARY, CODE, CONTINUOUS, COUNT, TEXT, RuleSet


def group_profiles(
    df: DataFrame, rules: RuleSet, kinds: Mapping[str, str], top: int = 10, max_categories: int | None = None
) -> dict[str, DataFrame]:
    """Tables ``binary``, ``continuous`` and ``categorical``, each with the feature group of its columns.

    All groups share one job per table kind.
    """
    place = {c: g for g, cs in rules.groups.items() for c in cs if c in df.columns and c != rules.target}
    by_kind = group_by_kind({c: kinds[c] for c in place})
    names = [x for pair in place.items() for x in pair]
    group = F.try_element_at(F.create_map(*[F.lit(x) for x in names]), F.col("column")).alias("group")
    # a page may ask for the first columns of every group only
    shown: list[str] = []
    for cs in rules.groups.values():
        here = [c for c in cs if c in place]
        codes = [c for c in here if kinds[c] == CODE] + [c for c in here if kinds[c] == TEXT]
        shown += codes[:max_categories]
    numbers = by_kind[CONTINUOUS] + by_kind[COUNT]
    out = {}
    if by_kind[BINARY]:
        out["binary"] = profile.binary_share(df, by_kind[BINARY]).select(group, "*")
    if numbers:
        out["continuous"] = profile.describe(df, numbers).select(group, "*")
    if shown:
        out["categorical"] = profile.top_values(df, shown, top).select(group, "*")
    return out


def slices_long(
    shares: DataFrame | None, numbers: DataFrame | None, target: str, classes: Sequence[str], kinds: Mapping[str, str]
) -> DataFrame:
    """(column, type, key, metric, value) of all outcome slices."""
    kind = F.try_element_at(F.create_map(*[F.lit(x) for p in kinds.items() for x in p]), F.col("column"))

    def long(table: DataFrame, key: Column, metrics: Sequence[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(m).alias("metric"), col(m).cast("double").alias("value")) for m in metrics])
        return table.select("column", kind.alias("type"), key.alias("key"), F.inline(pairs))

    parts = []
    if shares is not None:
        parts.append(long(shares, F.col("value"), classes))
    if numbers is not None:
        key = F.coalesce(col(target), F.lit(outcome.UNKNOWN))
        parts.append(long(numbers, key, ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def tier_table(top: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The first rows of every tier with their strongest driver."""
    return top.where(F.col("tier_rank") <= k).select(
        "tier", "tier_rank", col(key), "risk", F.col("top_drivers")[0]["feature"].alias("top_factor"), "overall_recommendation"
    )
