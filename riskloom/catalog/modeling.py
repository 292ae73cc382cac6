"""Fitted models in their full configuration.  SQL counterparts hold what the tables fix of their results: splits,
supports, totals, conditions that an optimum or an explanation must meet.

A run is fitted once and then reported on, so the queries on the same tables share it within a session.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.catalog.features import CORRELATION_FEATURES, WITH_TARGET, student_paths, student_signals
from riskloom.catalog.fixtures import PATHS, STUDENTS, student_records
from riskloom.catalog.registry import query, rounded
from riskloom.functions.expr import col, mapped
from riskloom.operators import correlation, evaluate, fairness, importance
from riskloom.operators.models import cross_validate, load_trained
from riskloom.operators.scenarios import Scenario
from riskloom.operators.split import stratified_folds
from riskloom.plans import student
from riskloom.plans.actions import ActionPlan
from riskloom.plans.modeling import Run, run_models
from riskloom.session import EVEN, shared_path, side_by_side, stage

POSITIVE = "Dropout"
MAIN = "Boosted_Trees"  # the model that action lists go by
BINARY_TARGET = {"Dropout": 1, "Enrolled": 0, "Graduate": 0}
TEXT_COLUMNS = ("Subject_Specific", "Academic_Stress_Level")

_runs: dict[tuple[str, str], Run] = {}
_tables: dict[tuple[str, str], DataFrame] = {}


def _once(cache: dict, spark: SparkSession, sf_dir: str, make):
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in cache:
        cache[at] = make()
    return cache[at]


def modeling_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Students with all derived features, staged once per session."""
    return _once(_tables, spark, sf_dir, lambda: stage(student_signals(spark, sf_dir), "modeling", EVEN))


def _numeric(df: DataFrame) -> list[str]:
    from riskloom.operators.schema import numeric_columns

    return numeric_columns(df, ["student_id", "batch", student.TARGET])


def fitted(spark: SparkSession, sf_dir: str) -> Run:
    def make() -> Run:
        df = modeling_table(spark, sf_dir)
        # a shuffled order that SQL knows, too
        order = F.pmod(F.col("student_id") * 2654435761, F.lit(4294967296))
        return run_models(df, "student_id", student.TARGET, _numeric(df), TEXT_COLUMNS, order=order)

    return _once(_runs, spark, sf_dir, make)


# ------------------------------------------------------------------ feature importance

_matrix = (
    "Age at enrollment",
    "Admission grade",
    "Debtor",
    "Curricular units 1st sem (grade)",
    "Curricular units 2nd sem (grade)",
    "GDP",
)


@query(
    "modeling_matrix",
    f"""WITH {STUDENTS}, known AS (SELECT *, CASE WHEN "Target" = 'Dropout' THEN 1.0 ELSE 0.0 END AS y FROM students
          WHERE "Target" IS NOT NULL), med AS (SELECT """
    + ", ".join(f'quantile_cont("{c}", 0.5) AS m{i}' for i, c in enumerate(_matrix))
    + " FROM known) SELECT CAST(y AS DOUBLE) AS y, "
    + ", ".join(f'round(CAST(coalesce("{c}", m{i}) AS DOUBLE), 6) AS "{c}"' for i, c in enumerate(_matrix))
    + " FROM known CROSS JOIN med",
)
def modeling_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stage(student_records(spark, sf_dir).select("Target", *[col(c) for c in _matrix]))
    return rounded(importance.modeling_matrix(s, student.TARGET, BINARY_TARGET)[0])


_CODED = f"""{PATHS}, coded AS (SELECT *, CASE "Target" WHEN 'Dropout' THEN 1 WHEN 'Enrolled' THEN 0 WHEN 'Graduate' THEN 0 END AS y
    FROM paths), grad AS (SELECT *, CASE "Target" WHEN 'Dropout' THEN 0 WHEN 'Enrolled' THEN 0 WHEN 'Graduate' THEN 1 END AS y FROM paths)"""


@query(
    "combined_ranking",
    f"""WITH {_CODED}, c AS ({WITH_TARGET}), g AS ({WITH_TARGET.replace("FROM coded", "FROM grad")}),
        a AS (SELECT feature, r AS coefficient, row_number() OVER (ORDER BY abs(r) DESC, feature) AS l1_rank FROM c
          WHERE r IS NOT NULL QUALIFY l1_rank <= 8),
        b AS (SELECT feature, r * r AS importance, row_number() OVER (ORDER BY r * r DESC, feature) AS rf_rank FROM g
          WHERE r IS NOT NULL QUALIFY rf_rank <= 8),
        m AS (SELECT feature, coalesce(coefficient, 0) AS coefficient, coalesce(importance, 0) AS importance,
          CAST(coalesce(l1_rank, 9) AS INT) AS l1_rank, CAST(coalesce(rf_rank, 9) AS INT) AS rf_rank FROM a FULL OUTER JOIN b USING (feature))
        SELECT feature, round(coefficient, 6) AS coefficient, round(importance, 6) AS importance, l1_rank, rf_rank,
          round((abs(coefficient) * 10 + importance) / 2, 6) AS combined_score FROM m
        ORDER BY (abs(coefficient) * 10 + importance) / 2 DESC, feature LIMIT 10""",
)
def combined_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merging of two rankings, on two measured ones: correlation with dropout, and with graduation squared."""
    s = stage(
        student_paths(spark, sf_dir).select(
            *[col(c) for c in CORRELATION_FEATURES],
            mapped(col("Target"), BINARY_TARGET).alias("_d"),
            mapped(col("Target"), {"Dropout": 0, "Enrolled": 0, "Graduate": 1}).alias("_g"),
        )
    )
    k = len(CORRELATION_FEATURES)
    a = correlation.correlation_with(s, CORRELATION_FEATURES, "_d", k).withColumnRenamed("correlation", "coefficient")
    b = correlation.correlation_with(s, CORRELATION_FEATURES, "_g", k).select(
        "feature", (F.col("correlation") * F.col("correlation")).alias("importance")
    )
    return rounded(importance.combined_importance(a, b, top=10, size=8))


def _ready(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    matrix, features = importance.modeling_matrix(
        modeling_table(spark, sf_dir), student.TARGET, BINARY_TARGET, ["student_id", "batch"]
    )
    return stage(importance.assembled(matrix, features), "matrix"), features


@query("l1_importance")
def l1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready, features = _ready(spark, sf_dir)
    return rounded(importance.l1_importance(ready, features))


@query("forest_importance")
def forest_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready, features = _ready(spark, sf_dir)
    return rounded(importance.forest_importance(ready, features))


@query("combined_importance")
def combined_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models are fitted once on the same staged matrix, at the same time."""
    ready, features = _ready(spark, sf_dir)
    lists = (importance.l1_importance, importance.forest_importance)
    l1, rf = side_by_side(spark, [partial(make, ready, features, importance.LIST_SIZE) for make in lists])
    return rounded(importance.combined_importance(l1, rf))


# ------------------------------------------------------------------ models

@query("model_comparison")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fitted(spark, sf_dir).comparison())


@query("model_reports")
def model_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fitted(spark, sf_dir).reports())


@query("model_confusions")
def model_confusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(spark, sf_dir).confusions()


@query("model_top_features")
def model_top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.top_features(fitted(spark, sf_dir).trained.importances(), "model", "feature", "importance"))


@query("model_best")
def model_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.best_model(fitted(spark, sf_dir).comparison()))


@query("model_fairness")
def model_fairness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fitted(spark, sf_dir).audit("Boosted_Trees", student.SENSITIVE_COLUMNS, POSITIVE))


@query("model_fairness_overall")
def model_fairness_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = fitted(spark, sf_dir).audit("Boosted_Trees", student.SENSITIVE_COLUMNS, POSITIVE)
    return rounded(fairness.overall_fairness(audit))


@query("forest_cross_validation")
def forest_cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = modeling_table(spark, sf_dir).where(F.col(student.TARGET).isNotNull())
    numeric = _numeric(df)
    folded = stage(stratified_folds(df, student.TARGET, "student_id", 5), "folds", EVEN)
    held = cross_validate(folded, student.TARGET, "fold", 5, numeric, key="student_id")
    return rounded(evaluate.cross_validation_score(held, "truth", "pred", "fold"))


@query("model_actions")
def model_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows by tier of the boosted model, with its strongest driver."""
    listed = ActionPlan.of(fitted(spark, sf_dir), MAIN, POSITIVE).tiers()
    first = F.inline(F.slice("top_drivers", 1, 1))
    return rounded(listed.select(*[c for c in listed.columns if c != "top_drivers"], first))


@query("model_drivers")
def model_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ActionPlan.of(fitted(spark, sf_dir), MAIN, POSITIVE).drivers())


@query("model_cohorts")
def model_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        ActionPlan.of(fitted(spark, sf_dir), "Boosted_Trees", POSITIVE).cohorts("Course", student.COURSE_NAMES)
    )


@query("model_policy")
def model_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy simulation with the forest as scorer."""
    plan = ActionPlan.of(fitted(spark, sf_dir), "Random_Forest", POSITIVE)
    return rounded(plan.policies(student.policies(F.col("risk") > 0.7)))


@query("model_what_if")
def model_what_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test row under three scenarios, scored by the forest."""
    plan = ActionPlan.of(fitted(spark, sf_dir), "Random_Forest", POSITIVE)
    return rounded(plan.what_if(student.what_if_scenarios(plan.run.trained.numeric)))


@query("saved_model_scores")
def saved_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models written to the shared folder, read back, and used on the test rows."""
    run = fitted(spark, sf_dir)
    path = shared_path(spark, "models")
    run.trained.save(path)
    back = load_trained(
        path, list(run.trained.models), run.trained.numeric, run.trained.categorical, run.trained.classes
    )
    again = back.score_all(run.test, ["student_id", student.TARGET])
    return rounded(again.groupBy("model").agg(F.avg((F.col("pred") == col(student.TARGET)).cast("int")).alias("accuracy")))


# ------------------------------------------------------------------ facts about a fitted run that the tables fix

_SPLIT = f"""{STUDENTS}, ordered AS (SELECT *, count(*) OVER (PARTITION BY "Target") AS _n,
    row_number() OVER (PARTITION BY "Target" ORDER BY (student_id * 2654435761) % 4294967296) AS _r
    FROM students WHERE "Target" IS NOT NULL),
  split AS (SELECT *, CASE WHEN _r <= floor(_n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM ordered),
  test AS (SELECT * FROM split WHERE split = 'test'),
  models AS (SELECT unnest(['Logistic_L1', 'Decision_Tree', 'Random_Forest', 'Boosted_Trees']) AS model)"""


@query("split_manifest", f"WITH {_SPLIT} SELECT student_id, split FROM split")
def split_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(spark, sf_dir).rows.select("student_id", "split")


@query(
    "model_supports",
    f"""WITH {_SPLIT} SELECT model, "Target" AS label, count(*) AS support FROM models CROSS JOIN test GROUP BY ALL""",
)
def model_supports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model is measured on all test rows."""
    return fitted(spark, sf_dir).reports().where(col("label").isin(*student.CLASSES)).select(
        "model", "label", F.col("support").cast("bigint").alias("support")
    )


@query(
    "model_cohort_sizes",
    f"""WITH {_SPLIT} SELECT "Course" AS cohort_id, count(*) AS n FROM test GROUP BY "Course" """,
)
def model_cohort_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ActionPlan.of(fitted(spark, sf_dir), "Boosted_Trees", POSITIVE).cohorts("Course").select("cohort_id", "n")


@query(
    "model_no_change",
    f"""WITH {_SPLIT} SELECT model, student_id, 0.0::DOUBLE AS risk_reduction FROM models CROSS JOIN test""",
)
def model_no_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scenario that changes nothing leaves every risk as it is, whatever the model."""
    run = fitted(spark, sf_dir)
    out = None
    for model in run.trained.models:
        moved = ActionPlan.of(run, model, POSITIVE).what_if([Scenario("nothing", {})])
        part = moved.select(F.lit(model).alias("model"), "student_id", "risk_reduction")
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@query(
    "saved_model_differences",
    f"""WITH {_SPLIT} SELECT model, count(*) AS n, 0::BIGINT AS differing FROM models CROSS JOIN test GROUP BY model""",
)
def saved_model_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models written and read back score every test row as before."""
    run = fitted(spark, sf_dir)
    path = shared_path(spark, "models")
    run.trained.save(path)
    back = load_trained(
        path, list(run.trained.models), run.trained.numeric, run.trained.categorical, run.trained.classes
    )
    p = [f"p_{c}" for c in run.trained.classes]
    again = back.score_all(run.test, ["student_id"]).select("model", "student_id", F.struct(*p).alias("now"))
    both = run.scored.select("model", "student_id", F.struct(*p).alias("then")).join(again, ["model", "student_id"])
    return both.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("now") != F.col("then")).alias("differing")
    )


@query(
    "l1_optimum",
    f"""WITH {STUDENTS} SELECT "Target" IS NOT NULL AS known, count(*) AS n, TRUE AS at_optimum FROM students
        WHERE "Target" IS NOT NULL GROUP BY ALL""",
)
def l1_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the L1 model learnt from, and whether gradients at its coefficients meet the conditions of the optimum.

    Of a coefficient other than 0 the gradient of the mean loss is the penalty with the other sign, of one that is 0 at
    most the penalty, of the intercept 0, each within 1e-4 of the penalty's scale.
    """
    ready, features = _ready(spark, sf_dir)
    model = importance.l1_model(ready)
    x = vector_to_array("raw")
    margin = model.margins(x)[0]
    off = 1 / (1 + F.exp(-margin)) - F.col("y")
    own = [i for i, s in enumerate(model.spreads) if s]
    sums = ready.select(
        off.alias("off"), *[((x[i] - model.means[i]) / model.spreads[i]).alias(f"z{i}") for i in own]
    ).agg(F.count(F.lit(1)).alias("n"), F.avg("off").alias("g"), *[F.avg(F.col("off") * F.col(f"z{i}")).alias(f"g{i}") for i in own])
    held = [F.abs("g") < 1e-4]
    for i in own:
        w, g = float(model.coefficients[0][i]), F.col(f"g{i}")
        held.append(F.abs(g + math.copysign(model.penalty, w)) < 1e-4 if w else F.abs(g) < model.penalty + 1e-4)
    good = held[0]
    for h in held[1:]:
        good = good & h
    return sums.select(F.lit(True).alias("known"), "n", good.alias("at_optimum"))


@query(
    "model_contribution_gaps",
    f"""WITH {_SPLIT} SELECT model, student_id, 0.0::DOUBLE AS gap FROM models CROSS JOIN test""",
)
def model_contribution_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What contributions leave unexplained of each test row's output less the mean output, for every model."""
    run = fitted(spark, sf_dir)
    out = None
    for name in run.trained.models:
        rows = run.trained.with_output(run.test, name, POSITIVE, "_output")
        explained = run.trained.explained(rows.select("student_id", "_output", *[col(c) for c in run.trained.features]), name, POSITIVE)
        told = F.aggregate("contributions", F.lit(0.0), lambda a, s: a + s["contribution"])
        gap = F.col("_output") - F.lit(run.trained.base(name, POSITIVE)) - told
        part = explained.select(F.lit(name).alias("model"), "student_id", F.abs(gap).alias("gap"))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@query(
    "model_confusion_totals",
    f"""WITH {_SPLIT} SELECT model, "Target" AS label, count(*) AS n FROM models CROSS JOIN test GROUP BY ALL""",
)
def model_confusion_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each model's confusion matrix add up to the test rows of their class."""
    run = fitted(spark, sf_dir)
    whole = sum((F.col(f"pred_{c}") for c in run.trained.classes), F.lit(0))
    table = run.confusions()
    label = next(c for c in table.columns if c != "model" and not c.startswith("pred_"))
    return table.select("model", col(label).alias("label"), whole.cast("bigint").alias("n"))
