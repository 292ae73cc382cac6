"""From a feature table to fitted models, audits and action lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.expr import col
from riskloom.operators import evaluate, fairness
from riskloom.operators.models import TITLES, Settings, Trained, train
from riskloom.operators.split import stratified_split
from riskloom.session import EVEN, stage


@dataclass(frozen=True)
class Run:
    """A fitted run: the split table, the models, and the whole test rows scored by each model."""

    rows: DataFrame
    trained: Trained
    scored: DataFrame
    key: str
    target: str

    @property
    def probabilities(self) -> dict[str, str]:
        return {c: f"p_{c}" for c in self.trained.classes}

    @property
    def test(self) -> DataFrame:
        return self.rows.where(F.col("split") == "test")

    def comparison(self) -> DataFrame:
        return evaluate.comparison_table(self.scored, self.target, "pred", self.probabilities, "model")

    def reports(self) -> DataFrame:
        return evaluate.classification_report(self.scored, self.target, "pred", ["model"])

    def confusions(self) -> DataFrame:
        return evaluate.confusion_matrix(self.scored, self.target, "pred", self.trained.classes, ["model"])

    def audit(self, model: str, attributes: Sequence[str], positive: str) -> DataFrame:
        """Fairness of one model on the test rows; predictions are labels, as the truth is."""
        judged = self.scored.where(F.col("model") == model)
        return fairness.full_audit(fairness.group_rates(judged, attributes, self.target, "pred", positive))


def run_models(
    df: DataFrame,
    key: str,
    target: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    settings: Settings = Settings(),
    names: Sequence[str] = tuple(TITLES),
    share: float = 0.2,
    order: Column | None = None,
) -> Run:
    """Split, fit on the training side, score the test side with every model.

    ``order`` replaces the hash order of the split.
    """
    known = df.where(col(target).isNotNull())
    rows = stage(stratified_split(known, target, key, share, order), "split", EVEN)
    trained = train(rows.where(F.col("split") == "train"), target, numeric, categorical, settings, names)
    scored = trained.score_all(rows.where(F.col("split") == "test"), rows.columns)
    return Run(rows, trained, stage(scored, "scored", EVEN), key, target)
