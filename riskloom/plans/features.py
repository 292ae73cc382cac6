"""From a clean table to a feature table with its reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.expr import col, mapped
from riskloom.functions.text import has_any, tokens
from riskloom.operators import correlation, importance, signals, trajectory
from riskloom.operators.schema import is_number, numeric_columns
from riskloom.operators.trajectory import Period
from riskloom.session import stage


def subjects_by_key(texts: DataFrame, key: str, text: str, topics: Mapping[str, Sequence[str]]) -> DataFrame:
    """(key, subject): first topic named in any text of the key, NULL if none; one row per key."""
    words = texts.select(col(key), tokens(col(text)).alias("_w"))
    named = words.groupBy(col(key)).agg(
        *[F.max(has_any(F.col("_w"), lexicon)).alias(f"_t{i}") for i, lexicon in enumerate(topics.values())]
    )
    subject = F.lit(None).cast("string")
    for i, topic in reversed(list(enumerate(topics))):
        subject = F.when(F.col(f"_t{i}"), topic).otherwise(subject)
    return named.select(col(key), subject.alias("subject"))


def feature_table(
    df: DataFrame,
    key: str,
    first: Period,
    second: Period,
    age: str,
    international: str,
    debtor: str,
    texts: DataFrame | None = None,
    text_key: str = "key",
    text: str = "text",
    topics: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Add the trajectory features and, from the texts of each row's key, the signal features."""
    paths = trajectory.trajectory_features(df, first, second)
    if texts is None:
        nothing = F.lit(None).cast("string")
        return signals.signal_features(paths, age, international, debtor, nothing, F.lit(False))
    heard = subjects_by_key(texts, text_key, text, topics or {}).withColumnsRenamed(
        {text_key: "_text_key", "subject": "_subject"}
    )
    joined = paths.join(heard, col(key) == F.col("_text_key"), "left")
    out = signals.signal_features(
        joined, age, international, debtor, F.col("_subject"), F.col("_text_key").isNotNull()
    )
    return out.drop("_text_key", "_subject")


def feature_reports(
    df: DataFrame,
    target: str,
    ordinal: Mapping[str, int],
    matrices: Mapping[str, Sequence[str]],
    top: int = 20,
) -> dict[str, DataFrame]:
    """Summaries, level counts, the named correlation matrices, and the correlation with the outcome."""
    out = {
        "trajectory_summary": trajectory.feature_summary(df),
        "signal_summary": signals.signal_summary(df),
        "stress_levels": signals.level_distribution(df, "Academic_Stress_Level"),
    }
    for name, columns in matrices.items():
        matrix = correlation.correlation_matrix(df, [c for c in columns if c in df.columns])
        if matrix is not None:
            out[f"correlation_{name}"] = matrix
    coded = df.withColumn("_y", mapped(col(target), ordinal))
    columns = [c for c in numeric_columns(df, [target], indicators=False)]
    out["correlation_with_target"] = correlation.correlation_with(coded, columns, "_y", top)
    return out


def page_rows(reports: Mapping[str, DataFrame]) -> DataFrame:
    """(report, item, metric, number, text): the feature page as one table.

    Columns that name a row (feature, level, or the two columns of a pair) make its item; every other cell is
    a metric, held as number or as text.
    """
    out = None
    for name, df in reports.items():
        keys = [c for c in ("feature", "level", "a", "b") if c in df.columns]
        cells = F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("metric"),
                    (col(f.name) if is_number(f.dataType) else F.lit(None)).cast("double").alias("number"),
                    (F.lit(None) if is_number(f.dataType) else col(f.name)).cast("string").alias("text"),
                )
                for f in df.schema
                if f.name not in keys
            ]
        )
        item = F.concat_ws(" | ", *[col(c) for c in keys])
        rows = df.select(F.lit(name).alias("report"), item.alias("item"), F.inline(cells))
        out = rows if out is None else out.unionByName(rows)
    return out


def importance_reports(
    df: DataFrame,
    target: str,
    positive: Mapping[str, int],
    exclude: Sequence[str] = (),
    top: int = 20,
    trees: int = 100,
) -> dict[str, DataFrame]:
    """Both importance lists and their combination; each model is fitted once."""
    matrix, features = importance.modeling_matrix(df, target, positive, exclude)
    ready = stage(importance.assembled(matrix, features), "matrix")
    size = importance.LIST_SIZE
    l1 = importance.l1_importance(ready, features, size)
    forest = importance.forest_importance(ready, features, size, trees=trees)
    return {
        "l1": l1.limit(top),
        "forest": forest.limit(top),
        "combined": importance.combined_importance(l1, forest, top),
    }
