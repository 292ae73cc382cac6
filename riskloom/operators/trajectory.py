"""Features of a two-period history per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.expr import col, fixed, flag, number, ratio
from riskloom.operators.orderstats import few_distinct
from riskloom.operators.schema import is_number


@dataclass(frozen=True)
class Period:
    """Names of the five measures of one period; a name may be absent from the table."""

    grade: str
    approved: str
    enrolled: str
    evaluations: str
    unevaluated: str


# Thresholds of the trajectory features.
PASS_MARK = 9.5
BORDER_LOW, BORDER_HIGH = 9.0, 11.0
FULL_COMPLETION, POOR_COMPLETION = 0.9, 0.6
GHOST_LOW, GHOST_HIGH = 0.2, 0.5

# Features by category.
TRAJECTORY_FEATURES = {
    "Grade Trajectory": ["Delta_Grade", "Grade_Improvement", "Grade_Decline"],
    "Completion Rate": ["CR_Sem1", "CR_Sem2", "Delta_CR", "Completion_Collapse"],
    "Threshold Crossing": ["Fail_Crossing", "Borderline_Collapse"],
    "Evaluation Pressure": ["EvalPressure_Sem1", "EvalPressure_Sem2", "Delta_EvalPressure"],
    "Ghost Enrollment": ["GhostRate_Sem1", "GhostRate_Sem2", "Delta_GhostRate", "Ghost_Worsening"],
}


def trajectory_features(df: DataFrame, first: Period, second: Period) -> DataFrame:
    """Add the 16 trajectory features; all row-local, so one projection and no shuffle."""

    def measure(name: str, default: int) -> Column:
        return number(col(name)) if name in df.columns else F.lit(float(default))

    def rates(p: Period) -> tuple[Column, Column, Column, Column]:
        seats = measure(p.enrolled, 1)
        return (
            measure(p.grade, 0),
            ratio(measure(p.approved, 0), seats),
            ratio(measure(p.evaluations, 0), seats),
            ratio(measure(p.unevaluated, 0), seats),
        )

    g1, done1, load1, ghost1 = rates(first)
    g2, done2, load2, ghost2 = rates(second)
    return df.withColumns(
        {
            "Delta_Grade": g2 - g1,
            "Grade_Improvement": flag(g2 - g1 > 0),
            "Grade_Decline": flag(g2 - g1 < 0),
            "CR_Sem1": done1,
            "CR_Sem2": done2,
            "Delta_CR": done2 - done1,
            "Completion_Collapse": flag((done1 >= FULL_COMPLETION) & (done2 <= POOR_COMPLETION)),
            "Fail_Crossing": flag((g1 >= PASS_MARK) & (g2 < PASS_MARK)),
            "Borderline_Collapse": flag(g1.between(BORDER_LOW, BORDER_HIGH) & (g2 < BORDER_LOW)),
            "EvalPressure_Sem1": load1,
            "EvalPressure_Sem2": load2,
            "Delta_EvalPressure": load2 - load1,
            "GhostRate_Sem1": ghost1,
            "GhostRate_Sem2": ghost2,
            "Delta_GhostRate": ghost2 - ghost1,
            "Ghost_Worsening": flag((ghost1 < GHOST_LOW) & (ghost2 > GHOST_HIGH)),
        }
    )


def feature_summary(df: DataFrame, features: Mapping[str, Sequence[str]] = TRAJECTORY_FEATURES) -> DataFrame:
    """(category, feature, type, non_null, mean as text), in one aggregate after the size test."""
    listed = [(g, f) for g, fs in features.items() for f in fs if f in df.columns]
    names = [f for _, f in listed]
    numeric = {f for f in names if is_number(df.schema[f].dataType)}
    few = few_distinct(df, [f for f in names if f in numeric], 2)
    aggs = []
    for i, f in enumerate(names):
        aggs.append(F.count(col(f)).alias(f"n{i}"))
        if f in numeric:
            aggs.append(F.avg(col(f)).alias(f"a{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(g).alias("category"),
                F.lit(f).alias("feature"),
                F.lit("Binary" if few.get(f) is not None else "Continuous").alias("type"),
                F.col(f"n{i}").alias("non_null"),
                (fixed(F.col(f"a{i}"), 3) if f in numeric else F.lit("N/A")).alias("mean"),
            )
            for i, (g, f) in enumerate(listed)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))
