"""Cohort risk and two-group comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.functions.expr import col, graded, mapped, min_max, number

# Priority limits and texts.
PRIORITIES = ((0.6, "Critical"), (0.4, "High"), (0.25, "Medium"))
LOWEST = "Low"
COHORT_ACTIONS = {
    "Critical": "Immediate intervention: assign dedicated advisor and increase TA support",
    "High": "Increase TA support and monitor weekly",
    "Medium": "Monitor closely and provide supplemental resources",
    "Low": "Maintain current support level",
}
NEUTRAL = 0.5


def cohort_risk(df: DataFrame, cohort: str, risk: str, names: Mapping[int, str] | None = None) -> DataFrame:
    """(cohort_type, cohort_id, cohort_name, n, priority, avg_risk, recommended_action), riskiest first."""
    stats = (
        df.where(col(cohort).isNotNull())
        .groupBy(col(cohort).alias("cohort_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(col(risk)).alias("avg_risk"))
    )
    default = F.concat(F.lit(f"{cohort} "), F.col("cohort_id").cast("string"))
    name = mapped(F.col("cohort_id"), names, default) if names else default
    return (
        stats.withColumns(
            {
                "cohort_type": F.lit(cohort),
                "cohort_name": name,
                "priority": graded(F.col("avg_risk"), PRIORITIES, LOWEST),
            }
        )
        .withColumn("recommended_action", mapped(F.col("priority"), COHORT_ACTIONS))
        .orderBy(F.desc("avg_risk"), "cohort_id")
    )


def cohort_radar(
    df: DataFrame,
    attributes: Sequence[str],
    dimensions: Mapping[str, Sequence[str]],
    inverted: Sequence[str] = (),
) -> DataFrame:
    """(attribute, dimension, group_0, group_1, difference, largest_gap, stronger_group).

    Features are scaled to [0, 1] over the whole table and averaged per group
    and dimension; a dimension without usable features scores 0.5.  Attributes
    that do not have exactly two values are left out.
    """
    usable = [a for a in attributes if a in df.columns]
    features = list(dict.fromkeys(f for fs in dimensions.values() for f in fs if f in df.columns))
    row = df.agg(
        *[F.min(number(col(f))).alias(f"lo{i}") for i, f in enumerate(features)],
        *[F.max(number(col(f))).alias(f"hi{i}") for i, f in enumerate(features)],
    ).first()
    ends = {f: (row[f"lo{i}"], row[f"hi{i}"]) for i, f in enumerate(features)}
    spread = [f for f, (lo, hi) in ends.items() if lo is not None and hi > lo]
    place = {f: f"f{i}" for i, f in enumerate(spread)}
    scaled = df.select(
        *[number(col(a)).alias(a) for a in usable],
        *[min_max(number(col(f)), *ends[f], invert=f in inverted).alias(f"_{place[f]}") for f in spread],
    )
    # all attributes at once: every row counts once per attribute
    means = (
        scaled.unpivot([F.col(f"_{p}") for p in place.values()], [col(a) for a in usable], "attribute", "g")
        .where(F.col("g").isNotNull())
        .groupBy("attribute", "g")
        .agg(*[F.avg(f"_{p}").alias(p) for p in place.values()])
    )
    scores = []
    for d, fs in dimensions.items():
        known = [F.col(place[f]) for f in fs if f in place]
        value = sum(known[1:], known[0]) / len(known) if known else F.lit(NEUTRAL)
        scores.append(F.struct(F.lit(len(scores)).alias("no"), F.lit(d).alias("dimension"), F.round(value, 2).alias("s")))
    per = means.select("attribute", "g", F.inline(F.array(*scores)))
    pairs = (
        per.groupBy("attribute", "no", "dimension")
        .agg(F.count(F.lit(1)).alias("k"), F.min_by("s", "g").alias("group_0"), F.max_by("s", "g").alias("group_1"))
        .where(F.col("k") == 2)
        .withColumn("difference", F.round(F.col("group_1") - F.col("group_0"), 2))
    )
    # five rows per attribute
    largest = F.min(F.struct((-F.abs("difference")).alias("o"), F.col("no"), F.col("difference").alias("d")))
    return pairs.withColumn("m", largest.over(Window.partitionBy("attribute"))).select(
        "attribute",
        "dimension",
        "group_0",
        "group_1",
        "difference",
        (F.col("no") == F.col("m.no")).cast("int").alias("largest_gap"),
        F.when(F.col("m.d") > 0, "group_1").otherwise("group_0").alias("stronger_group"),
    )
