"""Group fairness of predictions, all sensitive attributes in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.expr import col

# Limits and labels.
MIN_IMPACT = 0.8
MAX_GAP = 0.1
FAIR, BIASED = "Fair", "Potential Bias"


def group_rates(df: DataFrame, attributes: Sequence[str], truth: str, pred: str, positive: str) -> DataFrame:
    """(attribute, group, sample_size, positive_rate, tpr, fpr); undefined rates are 0.

    Rows without a group are left out of that attribute only.
    """
    wide = df.select(
        col(truth).eqNullSafe(F.lit(positive)).alias("_t"),
        col(pred).eqNullSafe(F.lit(positive)).alias("_p"),
        *[col(a).cast("string").alias(a) for a in attributes],
    )
    t, p = F.col("_t"), F.col("_p")
    zero = F.lit(0.0)
    return (
        wide.unpivot([t, p], [col(a) for a in attributes], "attribute", "group")
        .where(F.col("group").isNotNull())
        .groupBy("attribute", "group")
        .agg(
            F.count(F.lit(1)).alias("sample_size"),
            F.avg(p.cast("int")).alias("positive_rate"),
            F.coalesce(F.try_divide(F.count_if(t & p), F.count_if(t)), zero).alias("tpr"),
            F.coalesce(F.try_divide(F.count_if(~t & p), F.count_if(~t)), zero).alias("fpr"),
        )
    )


def full_audit(rates: DataFrame) -> DataFrame:
    """(attribute, n_groups, disparate_impact, di_level, tpr_difference, fpr_difference, eo_level).

    Disparate impact is the lowest over the highest positive rate (1 if nobody
    is predicted positive); the differences are those of equalised odds.
    """
    low, high = F.min("positive_rate"), F.max("positive_rate")
    fair = (F.col("tpr_difference") < MAX_GAP) & (F.col("fpr_difference") < MAX_GAP)
    return (
        rates.groupBy("attribute")
        .agg(
            F.count(F.lit(1)).alias("n_groups"),
            F.when(high > 0, low / high).otherwise(1.0).alias("disparate_impact"),
            (F.max("tpr") - F.min("tpr")).alias("tpr_difference"),
            (F.max("fpr") - F.min("fpr")).alias("fpr_difference"),
        )
        .withColumn("di_level", F.when(F.col("disparate_impact") >= MIN_IMPACT, FAIR).otherwise(BIASED))
        .withColumn("eo_level", F.when(fair, FAIR).otherwise(BIASED))
    )


def disparate_impact(rates: DataFrame) -> DataFrame:
    """(attribute, n_groups, disparate_impact, fairness_level)."""
    return full_audit(rates).select(
        "attribute", "n_groups", "disparate_impact", F.col("di_level").alias("fairness_level")
    )


def equalized_odds(rates: DataFrame) -> DataFrame:
    """(attribute, tpr_difference, fpr_difference, fairness_level)."""
    return full_audit(rates).select(
        "attribute", "tpr_difference", "fpr_difference", F.col("eo_level").alias("fairness_level")
    )


def overall_fairness(audit: DataFrame) -> DataFrame:
    """One row: how many attributes are fair on each metric, and the verdict."""
    total = F.count(F.lit(1))
    di, eo = F.count_if(F.col("di_level") == FAIR), F.count_if(F.col("eo_level") == FAIR)
    return audit.agg(
        total.alias("total_features_audited"),
        di.alias("fair_on_disparate_impact"),
        eo.alias("fair_on_equalized_odds"),
        F.coalesce(F.try_divide(di, total), F.lit(0.0)).alias("di_fairness_rate"),
        F.coalesce(F.try_divide(eo, total), F.lit(0.0)).alias("eo_fairness_rate"),
        F.when((di == total) & (eo == total), "Pass").otherwise("Needs Review").alias("overall_fairness"),
    )
