"""Rule tables: what a domain knows about its columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column

BINARY = "binary"
CODE = "categorical_code"
TEXT = "categorical_text"
CONTINUOUS = "continuous"
COUNT = "count"
KINDS = (BINARY, CODE, TEXT, CONTINUOUS, COUNT)

SEVERITIES = ("FAIL", "WARN", "INFO")


@dataclass(frozen=True)
class Treatment:
    """What is done to a column's gaps (``indicator+median`` ...) or outliers (``flag_only``, ``winsorize``), and why."""

    action: str
    reason: str


@dataclass(frozen=True)
class Check:
    """A named row condition that should never hold; NULL never counts as a hit."""

    name: str
    severity: str
    needs: tuple[str, ...]
    hit: Column
    details: str


@dataclass(frozen=True)
class RuleSet:
    """All rules of one domain; an empty set leaves every decision to the data."""

    target: str | None = None
    groups: Mapping[str, Sequence[str]] = field(default_factory=dict)
    kinds: Mapping[str, str] = field(default_factory=dict)
    buckets: Sequence[tuple[str, frozenset[str]]] = ()
    fill_rules: Mapping[str, Treatment] = field(default_factory=dict)
    outlier_policies: Mapping[str, Treatment] = field(default_factory=dict)
    default_policy: Treatment = Treatment(
        "flag_only", "Default: Flag for monitoring without modification"
    )
    labels: Mapping[str, Mapping] = field(default_factory=dict)

    def bucket(self, column: str) -> str:
        """First rule bucket that lists the column."""
        if column == self.target:
            return "outcome"
        for name, members in self.buckets:
            if column in members:
                return name
        return "continuous_general"

    def fill_rule(self, column: str, kind: str | None = None) -> Treatment:
        """Rule of the bucket, else of the column's kind, else of continuous columns.

        The outcome itself is never filled.
        """
        if column == self.target:
            return Treatment("indicator", "Outcome: mark only, never fill")
        bucket = self.bucket(column)
        for key in (bucket, self.kinds.get(column, kind), CONTINUOUS):
            if key in self.fill_rules:
                return self.fill_rules[key]
        return Treatment("indicator", "No rule: mark only")

    def policy(self, column: str) -> Treatment:
        return self.outlier_policies.get(column, self.default_policy)


# Strategies and their wording.
FILL_RULES = {
    "binary": Treatment("indicator+mode", "Binary variable: use mode and indicator"),
    "categorical_code": Treatment("indicator+mode", "Coded category: use mode and indicator"),
    "categorical_text": Treatment("indicator+unknown", "Text category: fill with 'Unknown' and indicator"),
    "continuous": Treatment("indicator+median", "Continuous variable: use median and indicator"),
    "count": Treatment("indicator+zero", "Count variable: assume zero and indicator"),
    "critical_academic": Treatment(
        "indicator+median", "Academic signal: maintain indicator, use median imputation"
    ),
    "finance": Treatment("indicator+assume_no", "Financial variable: assume 'No' (0) and indicator"),
    "parent": Treatment("indicator+unknown", "Parent background: fill with 'Unknown' and indicator"),
    "macro": Treatment("indicator+median", "Macroeconomic context: use median and indicator"),
}
