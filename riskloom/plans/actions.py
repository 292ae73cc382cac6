"""Action lists and simulations of a fitted run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.expr import col
from riskloom.operators import actions, attribution, cohorts, scenarios
from riskloom.operators.scenarios import Scenario, Scorer
from riskloom.plans.modeling import Run


@dataclass(frozen=True)
class ActionPlan:
    """Test rows with their risk, and what follows from it."""

    run: Run
    model: str
    positive: str
    rows: DataFrame

    @classmethod
    def of(cls, run: Run, model: str, positive: str) -> ActionPlan:
        """The scored rows hold all columns of the test rows, so nothing is joined back."""
        if model not in run.trained.models:
            raise ValueError(f"the run has no {model} model; fitted are {', '.join(run.trained.models)}")
        rows = run.scored.where(F.col("model") == model).withColumnsRenamed(
            {"pred": "predicted_status", f"p_{positive}": "risk"}
        )
        return cls(run, model, positive, rows)

    def scorer(self, keep: Sequence[str]) -> Scorer:
        """The model as scorer of scenario tables, which must hold all its features."""

        def score(df: DataFrame) -> DataFrame:
            scored = self.run.trained.score(df, self.model, [c for c in keep if c in df.columns])
            return scored.withColumnRenamed(f"p_{self.positive}", "risk")

        return score

    def explained(self, rows: DataFrame) -> DataFrame:
        """Add the ``contributions`` of the features to this model's output, from the features as it was given them."""
        return self.run.trained.explained(rows, self.model, self.positive)

    def tiers(self, k: int = 50, drivers: int = 5) -> DataFrame:
        """The k riskiest rows per tier with rank, the drivers of the model that ranks them, actions and advice."""
        top = actions.top_per_tier(self.rows, "risk", self.run.key, k)
        explained = attribution.top_drivers(self.explained(top), drivers)
        return actions.with_actions(explained, "risk").select(
            col(self.run.key),
            "tier",
            "tier_rank",
            "risk_rank",
            "risk",
            col(self.run.target).alias("true_status"),
            "predicted_status",
            "top_drivers",
            "overall_recommendation",
        )

    def what_if(self, plans: Sequence[Scenario]) -> DataFrame:
        numeric = self.run.trained.numeric
        score = self.scorer([self.run.key, "scenario", "baseline_risk"])
        return scenarios.what_if(
            self.rows, self.run.key, "risk", numeric, plans, score, self.run.trained.categorical
        )

    def policies(self, plans: Sequence[Scenario], cut: float = 0.5, high: float = 0.7) -> DataFrame:
        numeric = self.run.trained.numeric
        return scenarios.policy_simulation(
            self.rows, "risk", numeric, plans, self.scorer(["scenario"]), cut, high, self.run.trained.categorical
        )

    def cohorts(self, cohort: str, names: Mapping[int, str] | None = None) -> DataFrame:
        return cohorts.cohort_risk(self.rows, cohort, "risk", names)

    def drivers(self, k: int = 10) -> DataFrame:
        """Features by the mean size of their contribution, with the action for the whole system."""
        features = self.run.trained.features
        found = attribution.global_drivers(self.explained(self.rows), dict.fromkeys(features, 0.0), k)
        return found.withColumn("policy_action", actions.system_action(F.col("feature")))

    def recommendations(self) -> DataFrame:
        return actions.strategic_recommendations(self.drivers())
