"""What-if scenarios and policy simulation for any scorer.

A scorer takes a table with the feature columns and returns it with the risk
column set; a fitted model's ``transform`` or a plain expression both fit.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.expr import col

Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Scenario:
    """Changed feature values, as expressions over the unchanged row."""

    name: str
    changes: Mapping[str, Column]
    description: str = ""
    eligible: Column | None = None  # rows it applies to; all if unset
    unit_cost: float = 0.0
    flat_cost: float = 0.0


def scenario_rows(df: DataFrame, features: Sequence[str], scenarios: Sequence[Scenario], keep: Sequence[str]) -> DataFrame:
    """One copy of each eligible row per scenario, with ``scenario`` and the changed features.

    ``keep`` are columns that go along unchanged: keys, and features that are no numbers.
    Copies are unfolded in place, so nothing is joined or shuffled.
    """
    copies = []
    for s in scenarios:
        copy = F.struct(
            F.lit(s.name).alias("scenario"),
            *[s.changes.get(f, col(f)).cast("double").alias(f) for f in features],
        )
        copies.append(copy if s.eligible is None else F.when(F.coalesce(s.eligible, F.lit(False)), copy))
    chosen = F.filter(F.array(*copies), lambda c: c.isNotNull())
    return df.select(*[col(c) for c in keep], F.inline(chosen))


def what_if(
    df: DataFrame,
    key: str,
    risk: str,
    features: Sequence[str],
    scenarios: Sequence[Scenario],
    scorer: Scorer,
    others: Sequence[str] = (),
) -> DataFrame:
    """(key, scenario, baseline_risk, new_risk, risk_reduction, reduction_pct) for every row.

    ``others`` are features that the scorer reads and no scenario changes, of any type.
    """
    based = df.withColumn("baseline_risk", col(risk))
    rows = scenario_rows(based, features, scenarios, [key, "baseline_risk", *others])
    scored = scorer(rows)
    gain = F.col("baseline_risk") - col(risk)
    return scored.select(
        col(key),
        "scenario",
        "baseline_risk",
        col(risk).alias("new_risk"),
        gain.alias("risk_reduction"),
        F.when(F.col("baseline_risk") > 0, gain / F.col("baseline_risk") * 100).otherwise(0.0).alias("reduction_pct"),
    )


def best_scenario(outcomes: DataFrame, key: str) -> DataFrame:
    """(key, scenario, risk_reduction): the scenario that lowers the risk most."""
    best = F.min(F.struct((-F.col("risk_reduction")).alias("o"), F.col("scenario").alias("s")))
    return outcomes.groupBy(col(key)).agg(best.alias("b")).select(
        col(key), F.col("b.s").alias("scenario"), (-F.col("b.o")).alias("risk_reduction")
    )


@dataclass(frozen=True)
class Baseline:
    rows: int
    positives: int
    high_risk: int
    eligible: Mapping[str, int] = field(default_factory=dict)
    eligible_positives: Mapping[str, int] = field(default_factory=dict)

    @property
    def rate(self) -> float:
        return self.positives / self.rows if self.rows else 0.0


def baseline(df: DataFrame, risk: str, scenarios: Sequence[Scenario], cut: float, high: float) -> Baseline:
    """Counts before any scenario, in one pass."""
    bad = col(risk) > cut
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("p"), F.count_if(col(risk) > high).alias("h")]
    for i, s in enumerate(scenarios):
        on = F.coalesce(s.eligible, F.lit(False)) if s.eligible is not None else F.lit(True)
        aggs += [F.count_if(on).alias(f"e{i}"), F.count_if(on & bad).alias(f"b{i}")]
    row = df.agg(*aggs).first()
    return Baseline(
        row["n"],
        row["p"],
        row["h"],
        {s.name: row[f"e{i}"] for i, s in enumerate(scenarios)},
        {s.name: row[f"b{i}"] for i, s in enumerate(scenarios)},
    )


def policy_simulation(
    df: DataFrame,
    risk: str,
    features: Sequence[str],
    scenarios: Sequence[Scenario],
    scorer: Scorer,
    cut: float = 0.5,
    high: float = 0.7,
    others: Sequence[str] = (),
) -> DataFrame:
    """(scenario, description, beneficiaries, total_cost, prevented, cost_per_save, new_rate, baseline_rate, ...).

    Only rows that a scenario changes are scored again; all others keep their
    outcome.  ``prevented`` is cut to a whole number; without any the cost per
    save is NULL.
    """
    base = baseline(df, risk, scenarios, cut, high)
    copies = scorer(scenario_rows(df, features, scenarios, list(others)))
    after = copies.groupBy("scenario").agg(F.count_if(col(risk) > cut).alias("_still"))
    facts = df.sparkSession.createDataFrame(
        [
            (
                s.name,
                s.description,
                base.eligible[s.name],
                float(s.unit_cost * base.eligible[s.name] + s.flat_cost),
                base.positives - base.eligible_positives[s.name],
            )
            for s in scenarios
        ],
        "scenario string, description string, beneficiaries bigint, total_cost double, _others bigint",
    )
    n = float(base.rows)
    out = facts.join(after, "scenario", "left").withColumn("_bad", F.col("_others") + F.coalesce("_still", F.lit(0)))
    saved = F.lit(base.positives) - F.col("_bad")
    return out.select(
        "scenario",
        "description",
        "beneficiaries",
        "total_cost",
        saved.cast("bigint").alias("prevented"),
        F.when(saved > 0, F.col("total_cost") / saved).alias("cost_per_save"),
        (F.col("_bad") / n if n else F.lit(0.0)).alias("new_rate"),
        F.lit(base.rate).alias("baseline_rate"),
        F.lit(base.rows).cast("bigint").alias("total_rows"),
        F.lit(base.high_risk).cast("bigint").alias("high_risk_rows"),
    )
