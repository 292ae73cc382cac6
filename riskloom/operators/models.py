"""Class models on tabular features: L1 logistic regression, tree, forest and boosted trees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.expr import col
from riskloom.operators import attribution, boosting, forest, sparse_logistic, trees
from riskloom.operators.orderstats import quantile_table
from riskloom.operators.split import class_weights, with_weights
from riskloom.session import EVEN, shared_path, side_by_side, stage

FEATURES, LABEL, WEIGHT, VALUES = "_features", "_label", "_weight", "_values"
ROWS_PER_PARTITION = 20_000


@dataclass(frozen=True)
class Settings:
    """Model sizes.  The defaults are the full configuration."""

    penalty: float = 0.1
    tree_depth: int = 5
    tree_leaf: int = 50
    forest_trees: int = 200
    forest_depth: int = 10
    forest_leaf: int = 30
    boost_rounds: int = 300
    boost_depth: int = 6
    boost_rate: float = 0.05
    boost_leaf: int = 5
    boost_rows: float = 0.8
    boost_columns: float = 0.8
    boost_gain: float = 0.1
    boost_l1: float = 0.1
    boost_l2: float = 1.0
    seed: int = 42


TITLES = {
    "Logistic_L1": "Logistic Regression (L1)",
    "Decision_Tree": "Decision Tree",
    "Random_Forest": "Random Forest",
    "Boosted_Trees": "Boosted Trees",
}


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fit_preparation(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> PipelineModel:
    """Median fill and label codes, both learned from the training rows, then one feature vector.

    Text columns get codes in alphabetical order; unseen and missing text has a
    code of its own.  Columns without any value are filled with 0.
    """
    medians = {c: q[0] for c, q in quantile_table(train, numeric, [0.5]).items()}
    filled = [
        f"COALESCE(TRY_CAST({_tick(c)} AS DOUBLE), {medians.get(c, 0.0)!r}D) AS _x{i}" for i, c in enumerate(numeric)
    ]
    stages: list = []
    if filled:
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__"))
    inputs = [f"_x{i}" for i in range(len(numeric))]
    if categorical:
        codes = [f"_c{i}" for i in range(len(categorical))]
        stages.append(
            StringIndexer(
                inputCols=list(categorical), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"
            )
        )
        inputs += codes
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    return Pipeline(stages=stages).fit(train)


def fit_model(name: str, ready: DataFrame, rows: int, classes: int, settings: Settings):
    """One of the four models on the prepared training table, whose weights are those of the classes.

    More rows than a partition holds get a forest that counts them block by block; Spark's own goes through all trees row by
    row and misses the caches at nearly every count.  The logistic penalty of a summed loss becomes 1 / (C * rows) for a mean loss.
    """
    s = settings
    if name == "Logistic_L1":
        return sparse_logistic.fit(ready, VALUES, LABEL, classes, 1.0 / (s.penalty * max(rows, 1)), WEIGHT)
    if name == "Boosted_Trees":
        return boosting.fit(ready, VALUES, LABEL, classes, boost_settings(s))
    common = {"featuresCol": FEATURES, "labelCol": LABEL, "weightCol": WEIGHT, "seed": s.seed}
    if name == "Decision_Tree":
        return DecisionTreeClassifier(maxDepth=s.tree_depth, minInstancesPerNode=s.tree_leaf, **common).fit(ready)
    if name == "Random_Forest" and rows > ROWS_PER_PARTITION:
        weights = [r[0] for r in ready.groupBy(LABEL).agg(F.max(WEIGHT).alias("w")).orderBy(LABEL).select("w").collect()]
        sizes = forest.ForestSettings(s.forest_trees, s.forest_depth, s.forest_leaf, seed=s.seed)
        return forest.fit(ready, VALUES, LABEL, weights, FEATURES, sizes)
    if name == "Random_Forest":
        return RandomForestClassifier(
            numTrees=s.forest_trees,
            maxDepth=s.forest_depth,
            minInstancesPerNode=s.forest_leaf,
            featureSubsetStrategy="sqrt",
            cacheNodeIds=True,  # else every job sends all trees to every task, which finds each row's nodes from the roots
            **common,
        ).fit(ready)
    raise ValueError(f"no model {name}; there are {', '.join(TITLES)}")


def boost_settings(s: Settings) -> boosting.BoostSettings:
    return boosting.BoostSettings(
        rounds=s.boost_rounds,
        depth=s.boost_depth,
        rate=s.boost_rate,
        least_weight=s.boost_leaf,
        least_gain=s.boost_gain,
        row_share=s.boost_rows,
        column_share=s.boost_columns,
        l1=s.boost_l1,
        l2=s.boost_l2,
        seed=s.seed,
    )


@dataclass(frozen=True)
class Trained:
    """Preparation and fitted models of one training table."""

    preparation: PipelineModel
    models: Mapping[str, Model | sparse_logistic.LinearModel | boosting.Boosted]
    numeric: Sequence[str]
    categorical: Sequence[str]
    classes: Sequence[str]
    paths: dict = field(default_factory=dict, compare=False, repr=False)  # trees read from Spark's models

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def score(self, df: DataFrame, name: str, keep: Sequence[str]) -> DataFrame:
        """(keep..., pred, p_<class>...) for every row."""
        return self._scored(self.preparation.transform(df), name, keep)

    def _scored(self, prepared: DataFrame, name: str, keep: Sequence[str]) -> DataFrame:
        model = self.models[name]
        if isinstance(model, Model):
            out = model.transform(prepared).withColumn("_p", vector_to_array("probability"))
        else:
            out = prepared.select(*[col(c) for c in keep], vector_to_array(FEATURES).alias(VALUES))
            out = self._with_margins(out, model).withColumn("_p", sparse_logistic.probabilities(F.col("_m")))
            out = out.withColumn("prediction", F.array_position("_p", F.array_max("_p")) - 1)
        names = F.array(*[F.lit(c) for c in self.classes])
        return out.select(
            *[col(c) for c in keep],
            F.element_at(names, F.col("prediction").cast("int") + 1).alias("pred"),
            *[F.element_at("_p", i + 1).alias(f"p_{c}") for i, c in enumerate(self.classes)],
        )

    @staticmethod
    def _with_margins(df: DataFrame, model) -> DataFrame:
        """Add ``_m``, a margin per class, from the feature array."""
        if isinstance(model, boosting.Boosted):
            return trees.with_margins(df, model.trees, VALUES, "_m")
        return df.withColumn("_m", F.array(*model.margins(F.col(VALUES))))

    def explained(self, df: DataFrame, name: str, label: str) -> DataFrame:
        """``df`` with ``contributions`` of every feature to the model's output for the class ``label``.

        They add up to the row's output less ``base``: margins of the linear and the boosted model, probabilities of the
        tree and the forest.
        """
        rows = self.prepared_array(df, VALUES)
        place, model = list(self.classes).index(label), self.models[name]
        if isinstance(model, sparse_logistic.LinearModel):
            found = attribution.vector_contributions(
                rows, F.col(VALUES), self.features, *self.linear_weights(label), model.means
            )
        else:
            found = trees.with_contributions(rows, *self._paths(name, place), VALUES, self.features)
        return found.drop(VALUES)

    def with_output(self, df: DataFrame, name: str, label: str, column: str) -> DataFrame:
        """Add the output that ``explained`` explains: the margin of ``label``, or of trees and forests its
        probability."""
        place, model = list(self.classes).index(label), self.models[name]
        if isinstance(model, Model):
            ready = model.transform(self.preparation.transform(df))
            return ready.select(*[col(c) for c in df.columns], vector_to_array("probability")[place].alias(column))
        ready = self._with_margins(self.prepared_array(df, VALUES), model)
        return ready.select(*[col(c) for c in df.columns], F.col("_m")[place].alias(column))

    def base(self, name: str, label: str) -> float:
        """The mean output of the training rows; of the linear model, its margin at their means."""
        place, model = list(self.classes).index(label), self.models[name]
        if isinstance(model, sparse_logistic.LinearModel):
            return float(model.intercepts[place])
        found, output = self._paths(name, place)
        return found.base(output)

    def linear_weights(self, label: str, name: str = "Logistic_L1") -> tuple[list[float]]:
        """Coefficients of one class per unit of each feature, 0 for features without spread."""
        model = self.models[name]
        own = model.coefficients[list(self.classes).index(label)]
        return ([float(w / s) if s > 0 else 0.0 for w, s in zip(own, model.spreads)],)

    def _paths(self, name: str, place: int) -> tuple[trees.Trees, int]:
        model = self.models[name]
        if isinstance(model, boosting.Boosted):
            return model.trees, place
        if (name, place) not in self.paths:
            spark = self._spark()
            self.paths[name, place] = trees.of_spark_model(model, place, spark, shared_path(spark, "nodes"))
        return self.paths[name, place], 0

    def prepared_array(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the prepared features as an array, in the order of ``features``."""
        ready = self.preparation.transform(df)
        return ready.select(*[col(c) for c in df.columns], vector_to_array(FEATURES).alias(name))

    def score_all(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Scores of every model, with ``model``; the features are prepared once."""
        prepared = stage(self.preparation.transform(df).select(*[col(c) for c in keep], FEATURES), "prepared", EVEN)
        out = None
        for name in self.models:
            part = self._scored(prepared, name, keep).withColumn("model", F.lit(name))
            out = part if out is None else out.unionByName(part)
        return out

    def importances(self) -> DataFrame:
        """(model, feature, importance): impurity gain, or mean size of the coefficients over the classes."""
        rows = []
        for name, model in self.models.items():
            rows += [(name, f, float(x)) for f, x in zip(self.features, _importance(model, len(self.features)))]
        spark = self._spark()
        return spark.createDataFrame(rows, "model string, feature string, importance double")

    def _spark(self):
        from pyspark.sql import SparkSession

        return SparkSession.active()

    def save(self, path: str) -> None:
        self.preparation.write().overwrite().save(f"{path}/preparation")
        spark = self._spark()
        for name, model in self.models.items():
            if isinstance(model, sparse_logistic.LinearModel):
                model.rows(spark, self.features).write.mode("overwrite").parquet(f"{path}/{name}")
            elif isinstance(model, boosting.Boosted):
                model.trees.nodes(spark).write.mode("overwrite").parquet(f"{path}/{name}")
            else:
                model.write().overwrite().save(f"{path}/{name}")


def _importance(model, n_features: int) -> list[float]:
    if isinstance(model, sparse_logistic.LinearModel):
        return list(abs(model.coefficients).mean(axis=0))
    if isinstance(model, boosting.Boosted):
        return list(model.trees.importances(n_features))
    return list(model.featureImportances.toArray())


def train(
    df: DataFrame,
    target: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    settings: Settings = Settings(),
    names: Sequence[str] = tuple(TITLES),
) -> Trained:
    """Fit the named models with balanced class weights.

    The prepared training table is staged once; every model reads it from there, all of them at the same time.
    """
    known = df.where(col(target).isNotNull())
    weights = class_weights(known, target)
    classes = sorted(weights)
    codes = None
    for i, c in enumerate(classes):
        hit = col(target) == c
        codes = F.when(hit, float(i)) if codes is None else codes.when(hit, float(i))
    preparation = fit_preparation(known, numeric, categorical)
    ready = preparation.transform(with_weights(known, target, WEIGHT, weights).withColumn(LABEL, codes))
    # without the notes that codes are categories: all models take them for numbers, so all splits are thresholds
    vector = F.col(FEATURES).alias(FEATURES, metadata={"codes": "numbers"})
    ready = stage(ready.select(vector, vector_to_array(FEATURES).alias(VALUES), LABEL, WEIGHT), "train", EVEN)
    rows = ready.count()
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_path(df.sparkSession, "checkpoints"))
    # every round is a job over all partitions, so these should be full
    ready = ready.coalesce(max(1, -(-rows // ROWS_PER_PARTITION)))
    found = side_by_side(
        df.sparkSession, [partial(fit_model, n, ready, rows, len(classes), settings) for n in names]
    )
    return Trained(preparation, dict(zip(names, found)), list(numeric), list(categorical), classes)


def load_trained(
    path: str, names: Sequence[str], numeric: Sequence[str], categorical: Sequence[str], classes: Sequence[str]
) -> Trained:
    from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    read = {
        "Logistic_L1": lambda p: sparse_logistic.LinearModel.of_rows(spark.read.parquet(p)),
        "Decision_Tree": DecisionTreeClassificationModel.load,
        "Random_Forest": RandomForestClassificationModel.load,
        "Boosted_Trees": lambda p: boosting.Boosted(trees.Trees.of_nodes(spark.read.parquet(p), len(classes)), []),
    }
    models = {n: read[n](f"{path}/{n}") for n in names}
    return Trained(PipelineModel.load(f"{path}/preparation"), models, list(numeric), list(categorical), classes)


def cross_validate(
    folded: DataFrame,
    target: str,
    fold: str,
    k: int,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    settings: Settings = Settings(),
    name: str = "Random_Forest",
    key: str = "id",
) -> DataFrame:
    """(key, fold, truth, pred): every row predicted by the model that did not see its fold.

    Folds are fitted side by side as long as their training tables leave cores free, two at least.
    """
    spark = folded.sparkSession
    rows = folded.count()
    at_once = max(2, spark.sparkContext.defaultParallelism // max(1, -(-rows // ROWS_PER_PARTITION)))

    def held(f: int) -> DataFrame:
        fitted = train(folded.where(col(fold) != f), target, numeric, categorical, settings, [name])
        scored = fitted.score(folded.where(col(fold) == f), name, [key, fold, target])
        return scored.select(col(key), col(fold), col(target).alias("truth"), "pred")

    return reduce(DataFrame.unionByName, side_by_side(spark, [partial(held, f) for f in range(1, k + 1)], at_once))
