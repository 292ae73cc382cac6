"""Which features tell a binary outcome apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.expr import col, mapped, number
from riskloom.operators import sparse_logistic
from riskloom.operators.orderstats import quantile_table
from riskloom.operators.schema import numeric_columns

# List sizes and score weight.
LIST_SIZE = 50
TOP = 20
COEFFICIENT_WEIGHT = 10


def modeling_matrix(
    df: DataFrame, target: str, positive: Mapping[str, int], exclude: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Numeric columns with medians filled in, and ``y``; rows without a known outcome go."""
    y = mapped(col(target), positive)
    known = df.withColumn("_y", y).where(F.col("_y").isNotNull())
    features = numeric_columns(df, [target, *exclude])
    medians = {c: q[0] for c, q in quantile_table(known, features, [0.5]).items()}
    features = [c for c in features if c in medians]
    filled = [F.coalesce(number(col(c)), F.lit(medians[c])).alias(c) for c in features]
    return known.select(F.col("_y").cast("double").alias("y"), *filled), features


def assembled(matrix: DataFrame, features: Sequence[str]) -> DataFrame:
    numbered = matrix.toDF("y", *[f"x{i}" for i in range(len(features))])
    out = VectorAssembler(inputCols=[f"x{i}" for i in range(len(features))], outputCol="raw").transform(numbered)
    return out.select("y", "raw")


def l1_model(ready: DataFrame, penalty: float = 0.1) -> sparse_logistic.LinearModel:
    """L1 logistic regression of ``y`` on standardised columns, ``penalty`` as the inverse weight of a summed loss."""
    rows = ready.count()
    return sparse_logistic.fit_binary(
        ready.select(vector_to_array("raw").alias("x"), "y"), "x", "y", 1.0 / (penalty * max(rows, 1))
    )


def l1_importance(ready: DataFrame, features: Sequence[str], k: int = TOP, penalty: float = 0.1) -> DataFrame:
    """(feature, coefficient) of the L1 model, largest size first."""
    pairs = [(f, float(c)) for f, c in zip(features, l1_model(ready, penalty).coefficients[0])]
    out = ready.sparkSession.createDataFrame(pairs, "feature string, coefficient double")
    return out.orderBy(F.desc(F.abs("coefficient")), "feature").limit(k)


def forest_importance(
    ready: DataFrame, features: Sequence[str], k: int = TOP, trees: int = 100, depth: int = 10, seed: int = 42
) -> DataFrame:
    """(feature, importance): impurity gain in a random forest, largest first."""
    model = RandomForestClassifier(
        featuresCol="raw", labelCol="y", numTrees=trees, maxDepth=depth, minInstancesPerNode=10, seed=seed
    ).fit(ready)
    pairs = [(f, float(c)) for f, c in zip(features, model.featureImportances.toArray())]
    out = ready.sparkSession.createDataFrame(pairs, "feature string, importance double")
    return out.orderBy(F.desc("importance"), "feature").limit(k)


def ranked(df: DataFrame, feature: str, order: Column, name: str, k: int) -> DataFrame:
    """Add a rank 1..k and keep those rows; one row per feature comes in."""
    w = Window.partitionBy(F.lit(1)).orderBy(order.desc(), col(feature))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def combined_importance(l1: DataFrame, forest: DataFrame, top: int = TOP, size: int = LIST_SIZE) -> DataFrame:
    """(feature, coefficient, importance, combined_score, l1_rank, rf_rank) of the best features of both lists.

    A feature missing from one list scores 0 there and ranks just behind it.
    """
    a = ranked(l1.select("feature", "coefficient"), "feature", F.abs("coefficient"), "l1_rank", size)
    b = ranked(forest.select("feature", "importance"), "feature", F.col("importance"), "rf_rank", size)
    both = (
        a.join(b, "feature", "full_outer")
        .fillna(0.0, ["coefficient", "importance"])
        .fillna(size + 1, ["l1_rank", "rf_rank"])
    )
    score = (F.abs("coefficient") * COEFFICIENT_WEIGHT + F.col("importance")) / 2
    return (
        both.withColumn("combined_score", score)
        .orderBy(F.desc("combined_score"), "feature")
        .limit(top)
        .select("feature", "coefficient", "importance", "combined_score", "l1_rank", "rf_rank")
    )
