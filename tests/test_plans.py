"""From three CSV batches to action lists, on student records."""

import pytest
from pyspark.sql import functions as F

from riskloom.catalog.features import TOPICS
from riskloom.catalog.fixtures import student_records
from riskloom.operators.models import Settings
from riskloom.functions.expr import col
from riskloom.operators.schema import numeric_columns
from riskloom.plans import actions, features, intake, modeling, report, student
from riskloom.session import stage
from riskloom.sources.batches import read_batches, write_csv, write_results, read_results
from riskloom.sources.tables import table

SMALL = Settings(forest_trees=20, boost_rounds=5, forest_leaf=10, tree_leaf=20)


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    s = stage(student_records(spark, sf_dir))
    paths = {}
    for b in (1, 2, 3):
        paths[b] = str(tmp_path_factory.mktemp("weeks") / f"week{b}.csv")
        write_csv(s.where(F.col("batch") == b).drop("batch"), paths[b])
    return stage(read_batches(spark, paths))


@pytest.fixture(scope="module")
def cleaned(raw):
    return intake.clean(raw, student.RULES, ["batch", "student_id"], student.GROUPS["Macro context"])


@pytest.fixture(scope="module")
def featured(spark, sf_dir, cleaned):
    talk = table(spark, sf_dir, "conversations").where("role = 'user'")
    return stage(
        features.feature_table(
            cleaned.table, "student_id", student.FIRST, student.SECOND, "Age at enrollment", "International", "Debtor",
            talk, "conv_id", "text", TOPICS,
        )
    )


@pytest.fixture(scope="module")
def plan(featured):
    numeric = numeric_columns(featured, ["batch", "student_id"])
    run = modeling.run_models(
        featured, "student_id", "Target", numeric, ["Subject_Specific", "Academic_Stress_Level"], SMALL,
        ["Logistic_L1", "Random_Forest"],
    )
    return actions.ActionPlan.of(run, "Random_Forest", "Dropout")


def test_batches_come_back_whole(spark, sf_dir, raw):
    assert raw.count() == table(spark, sf_dir, "customer").count()
    assert [c for c in raw.columns if c not in ("batch", "student_id")] == [
        c for c in student_records(spark, sf_dir).columns if c not in ("batch", "student_id")
    ]


def test_clean_table_has_no_gaps_but_the_outcome(cleaned):
    gaps = cleaned.table.agg(*[F.count_if(col(c).isNull()).alias(c) for c in cleaned.table.columns]).first().asDict()
    assert {c for c, n in gaps.items() if n} == {"Target"}
    assert gaps["Target"] == cleaned.table.agg(F.sum("Target__is_missing")).first()[0]
    assert cleaned.table.agg(F.min("GDP")).first()[0] >= 0
    assert "GDP__is_outlier" in cleaned.table.columns


def test_panels_of_all_segments(raw):
    panel = intake.segment_panels(raw.drop("student_id").withColumn("batch", F.col("batch").cast("string")), "batch", "Target", student.checks(), measures=student.MEASURES)
    rows = panel.collect()
    assert {r["segment"] for r in rows} == {"1", "2", "3", "Overall"}
    assert {r["block"] for r in rows} == {
        "basic", "dtype", "missing", "outcome", "drift_last", "drift_cum", "outlier", "audit", "severity",
    }
    missing = [r for r in rows if r["block"] == "missing" and r["metric"] == "missing_count"]
    assert all(sum(r["segment"] == s for r in missing) <= 5 for s in ("1", "2", "3", "Overall"))
    beyond = {(r["segment"], r["item"]): r["value"] for r in rows if r["metric"] == "outlier_count"}
    for (segment, item), n in beyond.items():
        if segment == "Overall":
            assert n == sum(x for (s, i), x in beyond.items() if i == item and s != "Overall")
    size = {r["segment"]: r["value"] for r in rows if r["metric"] == "rows"}
    assert size["Overall"] == size["1"] + size["2"] + size["3"]


def test_profiles(cleaned):
    kinds = {c: k for c, k in cleaned.kinds.items() if c in cleaned.table.columns}
    tables = report.group_profiles(cleaned.table, student.RULES, kinds)
    assert {r["group"] for r in tables["binary"].collect()} == {"Demographics", "Financial / administrative"}
    assert tables["continuous"].count() == len(student.MEASURES) + len(student.COUNTS)
    assert tables["categorical"].select("column").distinct().count() == len(student.CODES)


def test_feature_reports(featured):
    matrices = {"static": student.STATIC_CORRELATION, "signals": student.SIGNAL_CORRELATION}
    out = features.feature_reports(featured, "Target", student.TARGET_ORDINAL, matrices)
    assert out["trajectory_summary"].count() == 16
    assert out["correlation_static"].count() == 13**2
    assert 0 < out["correlation_with_target"].count() <= 20
    top = {r["feature"] for r in out["correlation_with_target"].collect()}
    assert not {c for c in top if c.endswith(("__is_missing", "__is_outlier"))}
    lists = features.importance_reports(featured, "Target", {"Dropout": 1, "Enrolled": 0, "Graduate": 0}, ["batch", "student_id"], trees=10)
    assert lists["combined"].count() == 20


def test_action_lists(spark, plan, tmp_path):
    tiers = plan.tiers()
    n = plan.rows.count()
    ranks = [r["risk_rank"] for r in tiers.collect()]
    assert len(ranks) == len(set(ranks)) and max(ranks) <= n
    outcomes = plan.what_if(student.what_if_scenarios(plan.run.trained.numeric))
    assert outcomes.count() == 3 * n
    same = outcomes.join(plan.rows.select("student_id", "risk"), "student_id")
    assert same.agg(F.max(F.abs(F.col("baseline_risk") - F.col("risk")))).first()[0] == 0
    policies = plan.policies(student.policies(F.col("risk") > 0.4), cut=0.35, high=0.4).collect()
    assert {r["scenario"] for r in policies} == {"Financial Aid Program", "Engagement Nudge System"}
    assert plan.cohorts("Course", student.COURSE_NAMES).agg(F.sum("n")).first()[0] == n
    assert plan.drivers().count() == 10
    assert plan.recommendations().count() >= 1
    write_results({"tiers": tiers, "cohorts": plan.cohorts("Course")}, str(tmp_path))
    assert read_results(spark, str(tmp_path), ["tiers"])["tiers"].count() == len(ranks)


def test_features_without_texts(cleaned):
    out = features.feature_table(cleaned.table, "student_id", student.FIRST, student.SECOND, "Age at enrollment", "International", "Debtor")
    r = out.select("Academic_Stress", "Subject_Specific", "Subject_Risk_Flag", "Subject_Difficulty_Score").distinct().collect()
    assert [tuple(x) for x in r] == [(None, "No_Feedback", 0, None)]
