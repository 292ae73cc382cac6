"""Edge semantics on small hand-made tables."""

import math

import pytest
from pyspark.sql import functions as F, types as T

from riskloom.functions.expr import binned, clip, col, fixed, graded, number, ratio, whole_number
from riskloom.operators import actions, correlation, drift, evaluate, fairness, missing, outcome, outliers, profile, quality, schema
from riskloom.operators.attribution import linear_contributions, logistic_score, top_drivers
from riskloom.operators.importance import combined_importance
from riskloom.operators.scenarios import Scenario, policy_simulation
from riskloom.operators.signals import base_stress, home_risk, stress_level, subject_difficulty, subject_flag
from riskloom.operators.trajectory import Period, trajectory_features
from riskloom.plans import rules as R, student


def one(df, c):
    return [r[0] for r in df.select(c).collect()]


def nums(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


# ---------------------------------------------------------------- scalars

def test_levels(spark):
    df = nums(spark, [0, 0.33, 0.3301, 0.67, 1, None, -0.1, 1.01])
    assert one(df, stress_level(F.col("x"))) == ["Low", "Low", "Medium", "Medium", "High", None, None, None]
    assert one(df, graded(F.col("x"), [(0.67, "High"), (0.33, "Medium")], "Low", "N/A"))[:6] == [
        "Low", "Low", "Medium", "Medium", "High", "N/A",
    ]
    with pytest.raises(ValueError):
        binned(F.col("x"), [0, 1], ["a", "b"])


def test_numbers(spark):
    df = spark.createDataFrame([("1",), ("2.5",), ("NaN",), ("x",), (None,), ("1e3",)], ["x"])
    assert one(df, number(F.col("x"))) == [1.0, 2.5, None, None, None, 1000.0]
    assert one(df, whole_number(F.col("x"))) == [1, None, None, None, None, 1000]


def test_clip_ratio_and_text(spark):
    df = nums(spark, [-1, 0.5, 3, None])
    assert one(df, clip(F.col("x"), 0.0, 1.0)) == [0.0, 0.5, 1.0, None]
    assert one(df, ratio(F.lit(1.0), F.col("x"))) == [None, 2.0, pytest.approx(1 / 3), None]
    assert one(df, fixed(F.col("x") * 1000, 1))[:3] == ["-1000.0", "500.0", "3000.0"]


def test_tiers_and_advice_share_their_limits(spark):
    df = nums(spark, [0.3999, 0.4, 0.7, 0.7001])
    assert one(df, actions.risk_tier(F.col("x"))) == ["on_track", "warning", "warning", "critical"]
    advice = one(df, actions.recommendation(F.col("x")))
    assert advice == [actions.ROW_ADVICE[2], actions.ROW_ADVICE[1], actions.ROW_ADVICE[1], actions.ROW_ADVICE[0]]


def test_keyword_actions_take_the_first_match(spark):
    df = spark.createDataFrame([("Tuition fees (grade)",), ("Debtor",), ("Evaluations",), ("Age",), ("GDP",)], ["x"])
    got = one(df, actions.row_action(F.col("x")))
    assert got == [actions.ROW_ACTIONS[i][1] for i in (0, 2, 3, 4)] + [actions.ROW_DEFAULT]
    assert one(df, actions.system_action(F.col("x")))[0] == actions.SYSTEM_ACTIONS[0][1]


# ---------------------------------------------------------------- schema

def test_coercion(spark):
    want = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType()),
                         T.StructField("d", T.DoubleType()), T.StructField("Target", T.LongType())])
    df = spark.createDataFrame([("1", "x", None, "9", "Dropout"), ("7.5", "2", 4, "9", "3")], "a string, b string, c int, e string, Target string")
    out = schema.coerce_to_schema(df, want, keep=["Target"])
    assert out.columns == want.names
    assert [tuple(r) for r in out.collect()] == [(1, None, None, None, "Dropout"), (None, 2.0, "4", None, "3")]
    assert schema.schema_difference(df, want) == {"missing": ["d"], "extra": ["e"]}


def test_kinds(spark):
    df = spark.range(30).select(
        (F.col("id") % 2).alias("flag"),
        F.lit(1).alias("ones"),
        (F.col("id") % 2 + 1).alias("pair"),
        (F.col("id") % 20).alias("code"),
        (F.col("id") % 21).alias("many"),
        (F.col("id") % 3).cast("double").alias("real"),
        F.lit("t").alias("text"),
        F.lit(None).cast("int").alias("empty"),
        F.col("id").alias("Gender"),
    )
    assert schema.classify_columns(df, student.RULES) == {
        "flag": "binary", "ones": "binary", "pair": "categorical_code", "code": "categorical_code", "many": "continuous",
        "real": "continuous", "text": "categorical_text", "empty": "categorical_text", "Gender": "binary",
    }


def test_numeric_selection(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 1, 0)], ["a", "b", "c", "a__is_missing", "b__is_outlier"])
    assert schema.numeric_columns(df, ["b"]) == ["a", "a__is_missing", "b__is_outlier"]
    assert schema.numeric_columns(df, indicators=False) == ["a", "b"]


# ---------------------------------------------------------------- rules

def test_student_rules():
    assert len([c for cs in student.GROUPS.values() for c in cs]) == 37
    assert student.RULES.bucket("Debtor") == "finance"
    assert student.RULES.bucket("Gender") == "demographic"
    assert student.RULES.bucket("Course") == "coded_categorical"
    assert student.RULES.bucket("GDP") == "macro"
    assert student.RULES.bucket("Target") == "outcome"
    assert student.RULES.bucket("Admission grade") == "continuous_general"
    assert student.RULES.fill_rule("Gender").action == "indicator+mode"
    assert student.RULES.fill_rule("Course").action == "indicator+mode"
    assert student.RULES.fill_rule("Mother's occupation").action == "indicator+unknown"
    assert student.RULES.fill_rule("Target").action == "indicator"
    assert student.RULES.policy("GDP").action == "winsorize"
    assert student.RULES.policy("Course").action == "flag_only"


# ---------------------------------------------------------------- missing

def test_fills(spark):
    df = spark.createDataFrame(
        [(1, 3, None, None, None, None), (2, 3, "b", 1, 5, 2.0), (None, 1, "c", None, None, 1.0), (None, 1, None, 0, 2, None)],
        "med int, mode int, txt string, fin int, cnt int, keep double",
    )
    strategies = {"med": "indicator+median", "mode": "indicator+mode", "txt": "indicator+unknown", "fin": "indicator+assume_no",
                  "cnt": "indicator+zero", "keep": "indicator"}
    out = missing.fit_fill(df, strategies).transform(df)
    assert [r["med"] for r in out.collect()] == [1.0, 2.0, 1.5, 1.5]  # a half median makes the column double
    assert [r["txt"] for r in out.collect()] == ["Unknown", "b", "c", "Unknown"]
    assert [r["fin"] for r in out.collect()] == [0, 1, 0, 0]
    assert [r["cnt"] for r in out.collect()] == [0, 5, 0, 2]
    assert [r["keep"] for r in out.collect()] == [None, 2.0, 1.0, None]
    marks = out.agg(*[F.sum(f"{c}__is_missing").alias(c) for c in strategies]).first().asDict()
    assert marks == {r["column"]: r["missing_count"] for r in missing.missing_summary(df).collect()} | {"mode": 0}


def test_mode_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "m int")
    assert [r["m"] for r in missing.fit_fill(df, {"m": "indicator+mode"}).transform(df).collect()] == [0, 0]


def test_target_is_never_filled(spark):
    df = spark.createDataFrame([("a", 1.0), (None, None)], "Target string, x double")
    out = missing.apply_plan(df, missing.missing_plan(df, R.RuleSet(target="Target", fill_rules=R.FILL_RULES)))
    assert [tuple(r[c] for c in ("Target", "Target__is_missing", "x")) for r in out.collect()] == [("a", 0, 1.0), (None, 1, 1.0)]


# ---------------------------------------------------------------- outliers

def flagged(spark, values):
    return sum(r["x__is_outlier"] for r in outliers.iqr_flags(nums(spark, values), ["x"]).collect())


def test_iqr_needs_twenty_values(spark):
    assert flagged(spark, [*range(18), 1000]) == 0
    assert flagged(spark, [*range(19), 1000]) == 1
    assert flagged(spark, [*range(19), 1000, None, None]) == 1


def test_no_spread_no_outlier(spark):
    assert flagged(spark, [5] * 30 + [99]) == 0
    same = outliers.zscore_flags(nums(spark, [5] * 30), ["x"])
    assert sum(r["x__is_outlier"] for r in same.collect()) == 0


def test_report_skips_codes_and_grades(spark):
    def report(k, name="x"):
        values = [i % k for i in range(200)] + [10_000]
        df = nums(spark, values).withColumnRenamed("x", name)
        return [r["column"] for r in outliers.outlier_report(df, [name]).collect()]

    assert report(24) == []  # 24 codes and the extreme value: 25 distinct
    assert report(25) == ["x"]
    assert report(25, "Final Grade") == []


def test_winsorized_values_lie_inside(spark):
    df = nums(spark, [*range(100), None, 10_000])
    out = outliers.winsorize(df, ["x"])
    ends = out.agg(F.min("x"), F.max("x"), F.count("x")).first()
    assert 0 < ends[0] <= 1 and ends[1] < 10_000 and ends[2] == 101


# ---------------------------------------------------------------- quality and drift

def test_basic_check_counts_repeats_with_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (1, None)], "a int, b int")
    r = quality.basic_check(df).first()
    assert (r["rows"], r["cols"], r["missing_cells"], r["duplicate_rows"]) == (4, 2, 3, 2)
    assert r["missing_cell_pct"] == 37.5 and r["has_missing"] == "Yes"


def test_repeated_rows(spark):
    rows = [(1, 0.0, "a"), (1, -0.0, "a"), (1, None, "b"), (1, None, "b"), (1, None, "b"), (2, None, None), (None, 2.0, None)]
    got = quality.repeated_rows(spark.createDataFrame(rows, "i int, x double, t string")).collect()
    assert sorted((r["t"], r["_n"]) for r in got) == [("a", 2), ("b", 3)]


def test_rows_that_differ_only_in_the_place_of_a_gap(spark):
    df = spark.createDataFrame(
        [(1.0, None, "a"), (None, 1.0, "a"), (0.0, None, "b"), (-0.0, None, "b")], "x double, y double, t string"
    )
    r = quality.basic_check(df).first()
    assert (r["rows"], r["missing_cells"], r["duplicate_rows"]) == (4, 4, 1)
    by = {r["t"]: (r["rows"], r["duplicate_rows"]) for r in quality.basic_check(df, ["t"]).collect()}
    assert by == {"a": (2, 0), "b": (2, 1)}


def test_basic_check_of_nothing(spark):
    r = quality.basic_check(spark.createDataFrame([], "a int, b int")).first()
    assert (r["rows"], r["missing_cells"], r["missing_cell_pct"], r["duplicate_rows"]) == (0, 0, 0.0, 0)


def test_audit_null_never_hits_and_absent_columns_are_left_out(spark):
    df = spark.createDataFrame([(5.0,), (None,), (90.0,)], "`Age at enrollment` double")
    got = {r["check_name"]: r["affected_rows"] for r in quality.integrity_audit(df, student.checks()).collect()}
    assert got == {"age_too_low": 1, "age_too_high": 1}


def test_drift_of_an_unseen_value(spark):
    a = spark.createDataFrame([("x",), ("x",), (None,)], "t string")
    b = spark.createDataFrame([("x",), ("y",)], "t string")
    got = {r["t"]: (r["this_pct"], r["ref_pct"], r["delta_pct"]) for r in drift.compare_shares(a, b, "t").collect()}
    assert got == {"x": (100.0, 50.0, 50.0), "y": (0.0, 50.0, -50.0)}


def test_drift_deltas_add_up_to_zero(spark):
    rows = [(b, "xyz"[(i * i + b) % 3]) for b in range(4) for i in range(20 + b) if not (b == 1 and (i * i + b) % 3 == 2)]
    df = spark.createDataFrame(rows, ["b", "t"])
    for table in (drift.drift_vs_previous(df, "b", "t"), drift.drift_vs_cumulative(df, "b", "t")):
        for r in table.groupBy("b").agg(F.sum("delta_pct").alias("s")).collect():
            assert r["s"] == pytest.approx(0, abs=1e-9)


def test_consecutive_alerts(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([60, 40, 45, 70, 30])], ["m", "v"])
    assert [r["alert"] for r in drift.period_change(df, "m", "v", 50).orderBy("m").collect()] == [0, 1, 1, 0, 1]
    assert [r["alert"] for r in drift.period_change(df, "m", "v", 50, 2).orderBy("m").collect()] == [0, 0, 1, 0, 0]


# ---------------------------------------------------------------- profiles

def test_histogram_keeps_the_largest_value(spark):
    got = [r["n"] for r in profile.histogram(nums(spark, [0, 1, 2, 3]), ["x"], 3).orderBy("bin").collect()]
    assert got == [1, 1, 2]
    flat = profile.histogram(nums(spark, [5, 5, 5]), ["x"], 4).collect()
    assert sum(r["n"] for r in flat) == 3


def test_crosstab_rows_add_up(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x"), ("b", None)], "v string, t string")
    got = {r["value"]: (r["x"], r["y"], r["z"]) for r in outcome.crosstab_pct(df, "v", "t", ["x", "y", "z"]).collect()}
    assert got == {"a": (50.0, 50.0, 0.0), "b": (100.0, 0.0, 0.0)}


def test_box_stats_both_ways(spark, monkeypatch):
    df = spark.createDataFrame([("g", float(x)) for x in [*range(1, 20), 100]] + [(None, 1.0)], "t string, x double")
    few = outcome.box_stats(df, ["x"], "t").collect()
    monkeypatch.setattr(outcome, "BOX_LIMIT", 0)
    assert outcome.box_stats(df, ["x"], "t").collect() == few
    assert (few[0]["fliers"], few[0]["whisker_high"]) == (1, 19.0)


# ---------------------------------------------------------------- features

P1 = Period("g1", "a1", "e1", "v1", "w1")
P2 = Period("g2", "a2", "e2", "v2", "w2")
COLUMNS = "g1 double, a1 int, e1 int, v1 int, w1 int, g2 double, a2 int, e2 int, v2 int, w2 int"


def test_trajectory(spark):
    rows = [(10.0, 9, 10, 12, 1, 8.0, 3, 6, 6, 4), (None, 1, 0, 1, 0, 12.0, 1, 2, 2, 0), (9.5, 5, 5, 5, 0, 9.5, 3, 5, 5, 3)]
    a, b, c = trajectory_features(spark.createDataFrame(rows, COLUMNS), P1, P2).collect()
    assert (a["Delta_Grade"], a["Grade_Decline"], a["Completion_Collapse"], a["Fail_Crossing"], a["Borderline_Collapse"], a["Ghost_Worsening"]) == (-2.0, 1, 1, 1, 1, 1)
    assert b["Delta_Grade"] is None and b["CR_Sem1"] is None and b["Delta_CR"] is None
    assert (b["Grade_Improvement"], b["Fail_Crossing"], b["Completion_Collapse"], b["Ghost_Worsening"]) == (0, 0, 0, 0)
    assert (c["Delta_Grade"], c["Grade_Improvement"], c["Grade_Decline"], c["Fail_Crossing"], c["Ghost_Worsening"]) == (0.0, 0, 0, 0, 1)


def test_trajectory_without_columns_uses_defaults(spark):
    r = trajectory_features(spark.createDataFrame([(1,)], ["id"]), P1, P2).first()
    assert (r["Delta_Grade"], r["CR_Sem1"], r["Completion_Collapse"]) == (0.0, 0.0, 0)


def test_signals(spark):
    df = spark.createDataFrame([(-5.0, 0.5), (None, None), (3.0, 1.0)], "d double, c double")
    assert one(df, base_stress(F.col("d"), F.col("c"))) == [0.5, 0.25, 0.0]
    df = spark.createDataFrame([(50.0, 1, 1), (20.0, 0, 1), (20.0, 0, None)], "a double, i int, d int")
    assert one(df, home_risk(F.col("a"), F.col("i"), F.col("d"))) == [1.0, 0.4, None]
    df = spark.createDataFrame([("None",), ("Math",), ("No_Feedback",), ("Other",)], ["s"])
    assert one(df, subject_flag(F.col("s"))) == [0, 1, 0, 1]
    assert one(df, subject_difficulty(F.col("s"))) == [0.0, 1.0, None, 0.3]


# ---------------------------------------------------------------- correlation and importance

def test_correlation_matches_pandas(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    p = pd.DataFrame(rng.normal(1e6, 1, (300, 4)), columns=list("abcd"))
    p["b"] += 2 * p["a"]
    p.loc[::3, "c"] = None
    p.loc[1::4, "d"] = None
    p["k"] = 1.0
    df = spark.createDataFrame(p.astype(object).where(p.notna(), None).values.tolist(), "a double, b double, c double, d double, k double")
    want = p.corr()
    for r in correlation.correlation_matrix(df, list("abcdk")).collect():
        w = want.loc[r["a"], r["b"]]
        assert (r["r"] is None) if math.isnan(w) else r["r"] == pytest.approx(w, abs=1e-9)
    assert correlation.correlation_matrix(df, ["a"]) is None


def test_correlation_flat_on_common_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (2.0, None)], "a double, b double")
    got = {(r["a"], r["b"]): r["r"] for r in correlation.correlation_matrix(df, ["a", "b"]).collect()}
    assert got["a", "b"] is None


def test_combined_ranking(spark):
    a = spark.createDataFrame([("x", -2.0), ("y", 1.0)], "feature string, coefficient double")
    b = spark.createDataFrame([("y", 0.7), ("z", 0.3)], "feature string, importance double")
    got = {r["feature"]: (r["combined_score"], r["l1_rank"], r["rf_rank"]) for r in combined_importance(a, b).collect()}
    assert got == {"x": (10.0, 1, 51), "y": (pytest.approx(5.35), 2, 1), "z": (pytest.approx(0.15), 51, 2)}


# ---------------------------------------------------------------- evaluation and fairness

def test_report_without_hits_is_zero(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "b"), ("c", "b")], ["t", "p"])
    got = {r["label"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in evaluate.classification_report(df, "t", "p").collect()}
    assert got["a"] == (0.0, 0.0, 0.0, 1) and got["b"] == (pytest.approx(1 / 3), 1.0, 0.5, 1)
    assert got["accuracy"][0] == pytest.approx(1 / 3) and got["macro avg"][2] == pytest.approx(0.5 / 3)
    total = evaluate.confusion_matrix(df, "t", "p", ["a", "b", "c", "d"]).collect()
    assert sum(r[f"pred_{k}"] for r in total for k in "abcd") == 3 and len(total) == 4


def test_fairness_edges(spark):
    none = spark.createDataFrame([("n", "n", "g1"), ("n", "n", "g2")], ["t", "p", "g"])
    rates = fairness.group_rates(none, ["g"], "t", "p", "y")
    assert fairness.disparate_impact(rates).first()["disparate_impact"] == 1.0
    assert {r["tpr"] for r in rates.collect()} == {0.0}
    edge = spark.createDataFrame([("y", "y", "g1")] * 10 + [("y", "y", "g2")] * 8 + [("n", "n", "g2")] * 2, ["t", "p", "g"])
    r = fairness.disparate_impact(fairness.group_rates(edge, ["g"], "t", "p", "y")).first()
    assert (r["disparate_impact"], r["fairness_level"]) == (0.8, "Fair")


def test_imbalance_levels(spark):
    def level(n):
        df = spark.createDataFrame([("a",)] * n + [("b",)] * 10, ["c"])
        r = evaluate.class_imbalance(df, "c").first()
        return r["severity"], r["report_level"]

    assert level(14) == ("Light", "Minimal Imbalance")
    assert level(29) == ("Light", "Light Imbalance")
    assert level(30) == ("Moderate", "Moderate Imbalance")
    assert level(100) == ("Severe", "Severe Imbalance")


# ---------------------------------------------------------------- attribution and scenarios

def test_contributions_add_up_to_the_margin(spark):
    w = {"a": 2.0, "b": -1.0, "c": 0.5}
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0), (2, 4.0, None, 0.0), (3, -1.0, 5.0, 2.0)], "id int, a double, b double, c double")
    out = top_drivers(linear_contributions(df, w), 2).collect()
    margins = [2 - 2 + 1.5, 8 - 0 + 0, -2 - 5 + 1]
    mean = sum(margins) / 3
    for r, m in zip(out, margins):
        assert sum(x["contribution"] for x in r["contributions"]) == pytest.approx(m - mean)
        sizes = [abs(x["contribution"]) for x in r["top_drivers"]]
        assert sizes == sorted(sizes, reverse=True) and len(sizes) == 2


def test_policy_without_effect_costs_null_per_save(spark):
    df = logistic_score(spark.createDataFrame([(1, 3.0), (2, -3.0)], "id int, x double"), {"x": 1.0})
    score = lambda d: logistic_score(d, {"x": 1.0})
    plans = [
        Scenario("same", {"x": col("x")}, eligible=col("x") > 0, flat_cost=10),
        Scenario("help", {"x": col("x") - 10}, eligible=col("x") > 0, unit_cost=7),
        Scenario("nobody", {"x": col("x") - 10}, eligible=col("x") > 99, unit_cost=7),
    ]
    got = {r["scenario"]: r for r in policy_simulation(df, "risk", ["x"], plans, score).collect()}
    assert (got["same"]["prevented"], got["same"]["cost_per_save"], got["same"]["total_cost"]) == (0, None, 10.0)
    assert (got["help"]["prevented"], got["help"]["cost_per_save"], got["help"]["new_rate"]) == (1, 7.0, 0.0)
    assert (got["nobody"]["beneficiaries"], got["nobody"]["new_rate"]) == (0, 0.5)


def test_tiers_partition_the_rows(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") / 999).alias("risk"))
    top = actions.top_per_tier(df, "risk", "id", 10**6).collect()
    assert len(top) == 1000
    assert sorted(r["risk_rank"] for r in top) == list(range(1, 1001))
    assert all(r["risk_rank"] == 1000 - r["id"] for r in top)


def test_strategies(spark):
    def domains(*names):
        df = spark.createDataFrame([(i + 1, n) for i, n in enumerate(names)], ["rank", "feature"])
        return [r["domain"] for r in actions.strategic_recommendations(df).collect()]

    assert domains("Debtor", "GDP", "Age") == ["Financial Support"]
    assert domains("Curricular units", "Scholarship holder", "Age") == ["Financial Support", "Academic Support"]
    assert domains("GDP", "Age", "Inflation", "Debtor") == ["Monitoring"]


def test_a_value_that_one_batch_lacks(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, "b"), (3, None)]
    df = spark.createDataFrame(rows, "b int, t string")
    last = {(r["b"], r["t"]): (r["this_pct"], r["last_pct"]) for r in drift.drift_vs_previous(df, "b", "t").collect()}
    assert last == {(2, "a"): (100.0, 50.0), (2, "b"): (0.0, 50.0), (3, "a"): (0.0, 100.0), (3, "b"): (100.0, 0.0)}
    cum = {(r["b"], r["t"]): r["cum_pct"] for r in drift.drift_vs_cumulative(df, "b", "t").collect()}
    assert cum == {(2, "a"): 50.0, (2, "b"): 50.0, (3, "a"): 75.0, (3, "b"): 25.0}


def test_an_infinite_value_leaves_other_correlations(spark):
    rows = [(1.0, 2.0, float("inf")), (2.0, 4.0, 1.0), (3.0, 6.5, 2.0), (4.0, 8.0, None)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    got = {(r["a"], r["b"]): r["r"] for r in correlation.correlation_matrix(df, ["x", "y", "z"]).collect()}
    assert got["x", "y"] == pytest.approx(0.99586, abs=1e-4) and got["x", "x"] == 1.0
    assert got["x", "z"] is None and got["z", "z"] is None
    best = correlation.correlation_with(df, ["x", "z"], "y").collect()
    assert [r["feature"] for r in best] == ["x"]


def test_words_keep_their_accents(spark):
    from riskloom.functions.text import tokens

    df = spark.createDataFrame([("L'Été, señor: über-groß 12ß!",)], "s string")
    assert df.select(tokens(F.col("s"))).first()[0] == ["l", "été", "señor", "über", "groß", "ß"]


def test_many_rows_per_tier(spark):
    df = spark.range(5000).select("id", ((F.col("id") % 100) / 100.0).alias("risk"))
    got = actions.top_per_tier(df, "risk", "id", 1200).collect()
    want = sorted(((r, i) for i, r in ((i, (i % 100) / 100.0) for i in range(5000))), key=lambda x: (-x[0], x[1]))
    place = {i: n + 1 for n, (_, i) in enumerate(want)}
    assert len(got) == 3600
    for r in got:
        assert r["risk_rank"] == place[r["id"]] and 1 <= r["tier_rank"] <= 1200


def test_a_cluster_needs_a_named_folder(monkeypatch):
    from riskloom import session

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    Context.master = "local[2]"
    assert session.shared_dir(Session()).endswith("app")


# ---------------------------------------------------------------- lexicons, contracts, outliers of batches

def test_terms_of_several_words(spark):
    from riskloom.functions.text import has_any, known_terms, tokens, word_hits

    texts = ["Not good, not good at all", "good", "so not", "", None, "a a a"]
    words = spark.createDataFrame([(t,) for t in texts], "t string").select(tokens(F.col("t")).alias("w"))
    lexicon = ["good", "not good", "at all", "good not good", "a a", "good"]
    assert one(words, known_terms(F.col("w"), lexicon)) == [
        ["good", "good", "not good", "not good", "at all", "good not good"], ["good"], [], [], None, ["a a", "a a"],
    ]
    assert one(words, word_hits(F.col("w"), lexicon)) == [6, 1, 0, 0, None, 2]
    assert one(words, has_any(F.col("w"), ["not good", "so not"])) == [True, False, True, False, None, False]
    assert one(words, word_hits(F.col("w"), [])) == [0, 0, 0, 0, None, 0]
    # large lexicons are looked up in a set
    many = [f"word{i}" for i in range(500)] + ["good"]
    df = words.where(F.col("w").isNotNull()).select(word_hits(F.col("w"), many).alias("n"))
    assert [r["n"] for r in df.collect()] == [2, 1, 0, 0, 0]
    assert "INSET" in df._jdf.queryExecution().optimizedPlan().toString()


def test_schema_contract(spark):
    first = spark.createDataFrame([(1, 2.5, "x")], "id bigint, score double, note string")
    later = spark.createDataFrame([("7", "y", "2.0"), ("z", None, "3")], "id string, other string, score string")
    contract = schema.infer_schema(first)
    kept = schema.contract_rows(spark, contract)
    assert schema.read_contract(kept.orderBy(F.desc("position"))) == contract
    assert schema.contract_schema(contract) == first.schema
    out = schema.batches_by_contract({"a": first, "b": later})
    assert [tuple(r) for r in out.collect()] == [("a", 1, 2.5, "x"), ("b", 7, 2.0, None), ("b", None, 3.0, None)]
    out = schema.batches_by_contract({"b": later}, {"other": "string", "score": "int"})
    assert [tuple(r) for r in out.collect()] == [("b", "y", 2), ("b", None, 3)]
    nested = {"s": "struct<a:int,b:array<string>>", "d": "decimal(12,2)"}
    assert {f.name: f.dataType.simpleString() for f in schema.contract_schema(nested)} == nested


def test_outliers_of_each_batch(spark):
    rows = [("a", float(i), 0, float(i)) for i in range(40)] + [("b", 1000.0, 1, 5.5), ("b", None, 1, 6.5), (None, -1000.0, 1, 7.5)]
    df = spark.createDataFrame(rows, "week string, x double, code int, x_grade double")
    out = {(r["segment"], r["column"]): (r["outlier_count"], r["outlier_pct"]) for r in outliers.outlier_counts(df, ["x", "code", "x_grade"], "week").collect()}
    assert out == {("b", "x"): (1, 100.0), (None, "x"): (1, 100.0), ("Overall", "x"): (2, pytest.approx(200 / 42))}
    assert outliers.outlier_counts(df, ["code"], "week").count() == 0
    assert outliers.outlier_counts(df.limit(0), ["x"], "week").count() == 0


@pytest.mark.parametrize("k,tracked", [(3, 64), (1, 64), (10, 64), (3, 1024)])
def test_frequent_values_equal_the_full_count(spark, k, tracked):
    i = F.col("id")
    df = spark.range(6000, numPartitions=5).select(
        F.when(i % 4 == 0, "hot").when(i % 9 == 1, "warm").when(i % 9 == 2, "warm2").otherwise(i.cast("string")).alias("mixed"),
        (i % 3000).alias("twice each"),
        (i % 4).alias("few"),
        F.when(i % 3 > 0, i % 2).alias("gaps"),
        F.lit(None).cast("int").alias("none"),
    )
    want = {tuple(r) for r in profile.top_values(df, df.columns, k).select("column", "value", "count", "rank", "pct").collect()}
    got = profile.frequent_values(df, df.columns, k, tracked).select("column", "value", "count", "rank", "pct").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert profile.frequent_values(df.limit(0), ["few"], k, tracked).count() == 0
