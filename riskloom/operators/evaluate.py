"""Metrics of scored tables, computed by Spark from the rows themselves."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.expr import col

# Imbalance limits, labels and wording.
IMBALANCE = ((3.0, "Light", "class_weight_only"), (10.0, "Moderate", "class_weight_required"))
SEVERE = ("Severe", "advanced_methods_needed")
ADVICE = {
    "Light": "Light imbalance (%.2f:1). Use class_weight='balanced' (loss reweighting) without altering the data"
    " distribution. This is often preferable to SMOTE when feature semantics represent real individuals.",
    "Moderate": "Moderate imbalance (%.2f:1). Use class_weight='balanced' and/or model-specific reweighting (e.g.,"
    " scale_pos_weight for boosting). Avoid SMOTE if synthetic samples would harm interpretability or intervention"
    " relevance.",
    "Severe": "Severe imbalance (%.2f:1). Consider a combination of class weights, threshold tuning, and robust"
    " ensemble methods. Use synthetic sampling cautiously due to potential impacts on interpretability and"
    " intervention design.",
}
REPORT_LEVELS = ((1.5, "Minimal Imbalance"), (3.0, "Light Imbalance"), (5.0, "Moderate Imbalance"))
REPORT_SEVERE = "Severe Imbalance"

SCORES_PER_TASK = 250_000


def class_imbalance(df: DataFrame, label: str) -> DataFrame:
    """One row: ratio of largest to smallest class, severity, strategy, advice, and the report's label."""
    counts = df.where(col(label).isNotNull()).groupBy(col(label).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    # ties go to the alphabetically first class
    big = F.min(F.struct((-F.col("n")).alias("n"), "k"))
    small = F.min(F.struct("n", "k"))
    row = counts.agg(big.alias("b"), small.alias("s")).where(F.col("s").isNotNull()).select(
        F.col("b.k").alias("max_class"),
        (-F.col("b.n")).alias("max_class_count"),
        F.col("s.k").alias("min_class"),
        F.col("s.n").alias("min_class_count"),
        (F.col("b.n") / F.col("s.n") * -1).alias("ratio"),
    )

    def stepped(steps: Sequence[tuple], at: int, last: str) -> Column:
        out = None
        for step in steps:
            hit = F.col("ratio") < step[0]
            out = F.when(hit, step[at]) if out is None else out.when(hit, step[at])
        return out.otherwise(last)

    advice = None
    for severity, text in ADVICE.items():
        hit = F.col("severity") == severity
        said = F.format_string(text, F.col("ratio"))
        advice = F.when(hit, said) if advice is None else advice.when(hit, said)
    return (
        row.withColumn("severity", stepped(IMBALANCE, 1, SEVERE[0]))
        .withColumn("strategy", stepped(IMBALANCE, 2, SEVERE[1]))
        .withColumn("report_level", stepped(REPORT_LEVELS, 1, REPORT_SEVERE))
        .withColumn("recommendation", advice)
    )


def confusion_matrix(
    df: DataFrame, truth: str, pred: str, labels: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., truth, one ``pred_<label>`` per label); every label has a row in every group."""
    counts = df.where(col(truth).isin(*labels)).groupBy(*[col(b) for b in by], col(truth), col(pred)).agg(
        F.count(F.lit(1)).alias("n")
    )
    hits = [
        F.sum(F.when((col(truth) == t) & (col(pred) == p), F.col("n")).otherwise(0)).alias(f"_{i}_{j}")
        for i, t in enumerate(labels)
        for j, p in enumerate(labels)
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("truth"),
                *[F.coalesce(F.col(f"_{i}_{j}"), F.lit(0)).alias(f"pred_{p}") for j, p in enumerate(labels)],
            )
            for i, t in enumerate(labels)
        ]
    )
    return counts.groupBy(*[col(b) for b in by]).agg(*hits).select(*[col(b) for b in by], F.inline(rows))


def classification_report(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., label, precision, recall, f1, support) per class, then accuracy, macro and weighted averages.

    Only the counted pairs of true and predicted class are looked at a second time.
    """
    groups = [col(b) for b in by]
    pairs = df.groupBy(*groups, col(truth).alias("_t"), col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    hit = F.when(F.col("_t") == F.col("_p"), F.col("_n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("_t").alias("label"), F.col("_n").alias("support"), none.alias("said"), hit.alias("right")),
        F.struct(F.col("_p").alias("label"), none.alias("support"), F.col("_n").alias("said"), none.alias("right")),
    )
    per = (
        pairs.select(*groups, F.inline(sides))
        .where(F.col("label").isNotNull())
        .groupBy(*groups, "label")
        .agg(F.sum("support").alias("support"), F.sum("said").alias("said"), F.sum("right").alias("right"))
    )
    zero = F.lit(0.0)
    per = per.withColumns(
        {
            "precision": F.coalesce(F.try_divide("right", "said"), zero),
            "recall": F.coalesce(F.try_divide("right", "support"), zero),
            "f1": F.coalesce(F.try_divide(F.col("right") * 2.0, F.col("said") + F.col("support")), zero),
        }
    )
    metrics = ("precision", "recall", "f1")
    total = F.sum("support")
    accuracy = F.try_divide(F.sum("right"), total)
    each = F.collect_list(F.struct("label", *metrics, "support"))  # one entry per class
    summed = per.groupBy(*groups).agg(
        each.alias("_each"),
        total.alias("_all"),
        accuracy.alias("_acc"),
        *[F.avg(m).alias(f"_m_{m}") for m in metrics],
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), total).alias(f"_w_{m}") for m in metrics],
    )

    def line(label: str, columns: Sequence[str]) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            *[F.col(c).alias(m) for m, c in zip(metrics, columns)],
            F.col("_all").alias("support"),
        )

    averages = F.array(
        line("accuracy", ["_acc"] * 3),
        line("macro avg", [f"_m_{m}" for m in metrics]),
        line("weighted avg", [f"_w_{m}" for m in metrics]),
    )
    return summed.select(*groups, F.inline(F.concat("_each", averages)))


def roc_auc_ovr(
    df: DataFrame,
    truth: str,
    scores: Mapping[str, str],
    by: Sequence[str] = (),
    rows_per_task: int = SCORES_PER_TASK,
) -> DataFrame:
    """(by..., label, auc): one against the rest, ties counted half, plus the ``macro`` mean.

    Rows with equal scores are counted together first, so a score held by many
    rows is one record.  With more distinct scores than one task should sort,
    the scores are cut into ranges: the negatives below a range come from the
    range totals, those inside it from a window over that range only.
    A class without positives or without negatives has no curve; the macro
    mean is then 0.
    """
    groups = [col(b) for b in by]
    keys = [*groups, F.col("label")]
    wide = df.select(*groups, col(truth).alias("_t"), *[col(c).cast("double").alias(k) for k, c in scores.items()])
    long = wide.unpivot([*groups, F.col("_t")], [col(k) for k in scores], "label", "score")
    positive = F.col("_t").eqNullSafe(F.col("label"))
    counts = long.groupBy(*keys, "score").agg(F.count_if(positive).alias("p"), F.count_if(~positive).alias("n"))

    sizes = [F.approx_count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(scores.values())]
    most = df.groupBy(*groups).agg(*sizes).agg(*[F.max(f"d{i}") for i in range(len(sizes))]).first()
    parts = math.ceil(max((n or 0 for n in most), default=0) / rows_per_task)
    if parts > 1:
        # any borders give the same result; these make the ranges about equally full
        at = [i / parts for i in range(1, parts)]
        per_class = df.agg(
            *[F.percentile_approx(col(c).cast("double"), at, 10 * parts).alias(f"c{i}") for i, c in enumerate(scores.values())]
        ).first()
        borders = [-math.inf, *sorted({x for cuts in per_class for x in cuts}), math.inf]
        counts = Bucketizer(splits=borders, inputCol="score", outputCol="_r").transform(counts)
    else:
        counts = counts.withColumn("_r", F.lit(0.0))
    inside = Window.partitionBy(*keys, "_r").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    gains = counts.withColumn("_below", F.coalesce(F.sum("n").over(inside), F.lit(0))).groupBy(*keys, "_r").agg(
        F.sum("p").alias("p"),
        F.sum("n").alias("n"),
        F.sum(F.col("p") * (F.col("_below") + F.col("n") / 2.0)).alias("g"),
    )
    before = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    gains = gains.withColumn("_below", F.coalesce(F.sum("n").over(before), F.lit(0)))
    area = F.try_divide(
        F.sum(F.col("g") + F.col("p") * F.col("_below")), F.sum("p").cast("double") * F.sum("n").cast("double")
    )
    per = gains.groupBy(*keys).agg(area.alias("auc"))
    whole = F.when(F.count("auc") == F.count(F.lit(1)), F.avg("auc")).otherwise(0.0)
    both = per.groupBy(*groups).agg(F.collect_list(F.struct("label", "auc")).alias("_each"), whole.alias("_macro"))
    macro = F.array(F.struct(F.lit("macro").alias("label"), F.col("_macro").alias("auc")))
    return both.select(*groups, F.inline(F.concat("_each", macro)))


def cross_validation_score(df: DataFrame, truth: str, pred: str, fold: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., folds, mean, std): macro F1 per fold, its mean and population deviation."""
    report = classification_report(df, truth, pred, [*by, fold]).where(F.col("label") == "macro avg")
    return report.groupBy(*[col(b) for b in by]).agg(
        F.count(F.lit(1)).alias("folds"), F.avg("f1").alias("cv_score_mean"), F.stddev_pop("f1").alias("cv_score_std")
    )


def comparison_table(df: DataFrame, truth: str, pred: str, scores: Mapping[str, str], model: str) -> DataFrame:
    """(model, precision, recall, f1, auc): macro metrics, one row per model."""
    report = classification_report(df, truth, pred, [model]).where(F.col("label") == "macro avg")
    auc = roc_auc_ovr(df, truth, scores, [model]).where(F.col("label") == "macro").select(col(model), "auc")
    return report.drop("label", "support").join(auc, model)


def best_model(metrics: DataFrame, model: str = "model") -> DataFrame:
    """The model with the highest AUC, then the highest F1, then the first name."""
    best = F.min(F.struct((-F.col("auc")).alias("a"), (-F.col("f1")).alias("f"), col(model).alias("m")))
    return metrics.agg(best.alias("b")).select(
        F.col("b.m").alias("model"), (-F.col("b.a")).alias("auc"), (-F.col("b.f")).alias("f1")
    )


def top_features(df: DataFrame, model: str, feature: str, importance: str, k: int = 15) -> DataFrame:
    """(model, rank, feature, importance): the k strongest features per model."""
    order = Window.partitionBy(col(model)).orderBy(F.desc(col(importance)), col(feature))
    return (
        df.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(col(model), "rank", col(feature), col(importance))
    )
