"""Risk tiers, top rows per tier, and the actions tied to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.expr import col, contains_any, first_match
from riskloom.operators.orderstats import select_ranks

# Tier limits and texts.
CRITICAL, WARNING = 0.7, 0.4
TIERS = ("critical", "warning", "on_track")
ROW_ADVICE = (
    "Immediate intervention recommended: contact within 48 hours",
    "Proactive monitoring recommended: monthly check-ins",
    "On track: maintain current support level",
)
ROW_ACTIONS = (
    (("grade", "approved"), "Schedule tutoring sessions; recommend study groups"),
    (("tuition", "fee"), "Provide financial aid guidance; offer payment plan options"),
    (("debtor",), "Refer to financial counseling; explore debt restructuring options"),
    (("evaluation",), "Encourage attendance and assignment completion; provide structured check-ins"),
    (("age",), "Connect with support resources for non-traditional students"),
)
ROW_DEFAULT = "Schedule an advisor consultation"
SYSTEM_ACTIONS = (
    (("tuition", "fee"), "Establish emergency financial aid funding and improve payment flexibility"),
    (("scholarship",), "Expand scholarship funding and eligibility review"),
    (("grade", "approved"), "Strengthen academic support programs and targeted tutoring"),
    (("evaluation",), "Review assessment practices and provide structured learning supports"),
)
SYSTEM_DEFAULT = "Monitor the factor and evaluate targeted interventions"
STRATEGIES = (
    (
        ("tuition", "fee", "scholarship", "debtor"),
        ("Financial Support", "Critical", "Strengthen financial support pathways"),
    ),
    (
        ("grade", "approved", "evaluation", "curricular"),
        ("Academic Support", "High", "Expand tutoring and academic success programs"),
    ),
)
STRATEGY_DEFAULT = ("Monitoring", "Medium", "Continue monitoring and refine intervention criteria")


def _tiered(p: Column, texts: Sequence[str]) -> Column:
    return (
        F.when(p > CRITICAL, texts[0]).when(p >= WARNING, texts[1]).when(p < WARNING, texts[2])
    )


def risk_tier(p: Column) -> Column:
    """critical above 0.7, warning from 0.4 to 0.7, on_track below."""
    return _tiered(p, TIERS)


def recommendation(p: Column) -> Column:
    """Advice of the row's tier, with the same limits as the tier."""
    return _tiered(p, ROW_ADVICE)


def row_action(feature: Column) -> Column:
    return first_match(feature, ROW_ACTIONS, ROW_DEFAULT)


def system_action(feature: Column) -> Column:
    return first_match(feature, SYSTEM_ACTIONS, SYSTEM_DEFAULT)


def top_per_tier(df: DataFrame, risk: str, key: str, k: int = 50) -> DataFrame:
    """The k riskiest rows of every tier, with ``tier``, ``tier_rank`` and ``risk_rank`` over all rows.

    Tiers are score ranges, so a row's rank over the whole table is its rank in
    the tier plus the size of the tiers above; no window spans the table.  Rows
    below the k-th score of their tier go before the window, so it sees k rows
    of a tier and those that tie with the last one.
    """
    known = df.where(col(risk).isNotNull() & ~F.isnan(col(risk).cast("double")))
    tiered = known.withColumn("tier", risk_tier(col(risk)))
    scores = tiered.select("tier", col(risk).cast("double").alias("value"))
    found = select_ranks(scores, ["tier"], lambda _, n: [max(n - k, 0)])
    sizes = {tier: n for (tier,), (n, _) in found.items()}
    cut = F.lit(float("-inf"))
    for (tier,), (_, at) in found.items():
        cut = F.when(F.col("tier") == tier, F.lit(min(at.values()))).otherwise(cut)
    tiered = tiered.where(col(risk).cast("double") >= cut)
    order = Window.partitionBy("tier").orderBy(F.desc(col(risk)), col(key))
    before = F.lit(0)
    above, run = None, 0
    for t in TIERS:
        hit = F.col("tier") == t
        above = F.when(hit, run) if above is None else above.when(hit, run)
        run += sizes.get(t, 0)
    best = tiered.withColumn("tier_rank", F.row_number().over(order)).where(F.col("tier_rank") <= k)
    return best.withColumn("risk_rank", (F.coalesce(above, before) + F.col("tier_rank")).cast("bigint"))


def with_actions(df: DataFrame, risk: str) -> DataFrame:
    """Add an action to every top driver, and the overall recommendation."""
    drivers = F.transform(
        "top_drivers",
        lambda s: F.struct(
            s["feature"].alias("feature"),
            s["value"].alias("value"),
            s["contribution"].alias("contribution"),
            row_action(s["feature"]).alias("action"),
        ),
    )
    return df.withColumns({"top_drivers": drivers, "overall_recommendation": recommendation(col(risk))})


def strategic_recommendations(drivers: DataFrame, top: int = 3) -> DataFrame:
    """(domain, priority, action) that the strongest drivers call for, or plain monitoring.

    ``drivers`` holds (rank, feature), a few rows.
    """
    names = drivers.where(F.col("rank") <= top).agg(F.collect_list("feature").alias("f"))

    def text(parts: tuple[str, str, str]) -> Column:
        return F.struct(*[F.lit(x).alias(n) for n, x in zip(("domain", "priority", "action"), parts)])

    def named(words: Sequence[str]) -> Column:
        return F.exists("f", lambda x: contains_any(x, words))

    wanted = F.filter(
        F.array(*[F.when(named(words), text(parts)) for words, parts in STRATEGIES]), lambda s: s.isNotNull()
    )
    return names.select(
        F.inline(F.when(F.size(wanted) > 0, wanted).otherwise(F.array(text(STRATEGY_DEFAULT))))
    )
