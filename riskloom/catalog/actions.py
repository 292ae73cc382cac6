"""Risk tiers, drivers, cohorts and scenarios on student records with a fixed linear score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.catalog.fixtures import STUDENTS, student_records
from riskloom.catalog.registry import query, rounded
from riskloom.functions.expr import col
from riskloom.operators import actions, attribution, cohorts, scenarios
from riskloom.operators.orderstats import global_rank
from riskloom.plans import student
from riskloom.session import stage
from riskloom.sources.tables import table

G2 = "Curricular units 2nd sem (grade)"
A2 = "Curricular units 2nd sem (approved)"
E2 = "Curricular units 2nd sem (evaluations)"

# a fixed score, so that both engines rank the same rows
COEFFICIENTS = {
    "Age at enrollment": 0.03,
    "Debtor": 1.1,
    "Tuition fees up to date": -0.9,
    "Scholarship holder": -0.7,
    A2: -0.55,
    G2: -0.12,
    E2: -0.03,
    "Displaced": 0.4,
    "Gender": 0.3,
    "Unemployment rate": 0.05,
    "Admission grade": 0.002,
}
INTERCEPT = 1.3


def _scorer(df: DataFrame) -> DataFrame:
    return attribution.logistic_score(df, COEFFICIENTS, INTERCEPT)


def scored_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scorer(student_records(spark, sf_dir))


def _margin(values: dict[str, str] | None = None) -> str:
    """SQL of the margin; ``values`` replaces columns by other expressions."""
    values = values or {}
    terms = "".join(
        f" + coalesce(CAST({values.get(c, chr(34) + c + chr(34))} AS DOUBLE), 0) * ({w})::DOUBLE" for c, w in COEFFICIENTS.items()
    )
    return f"({INTERCEPT}::DOUBLE{terms})"


def _risk(values: dict[str, str] | None = None) -> str:
    return f"1 / (1 + exp(-{_margin(values)}))"


SCORED = f"{STUDENTS}, scored AS (SELECT *, {_risk()} AS risk FROM students)"
_TIER = "CASE WHEN risk > 0.7 THEN 'critical' WHEN risk >= 0.4 THEN 'warning' ELSE 'on_track' END"
_ADVICE = (
    "CASE WHEN risk > 0.7 THEN 'Immediate intervention recommended: contact within 48 hours' "
    "WHEN risk >= 0.4 THEN 'Proactive monitoring recommended: monthly check-ins' "
    "ELSE 'On track: maintain current support level' END"
)


@query(
    "risk_tiers",
    f"""WITH {SCORED} SELECT student_id, round(risk, 6) AS risk, {_TIER} AS tier, {_ADVICE} AS recommendation FROM scored""",
)
def risk_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_students(spark, sf_dir)
    return rounded(
        s.select(
            "student_id",
            "risk",
            actions.risk_tier(F.col("risk")).alias("tier"),
            actions.recommendation(F.col("risk")).alias("recommendation"),
        )
    )


@query(
    "risk_rank",
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS risk_rank FROM orders""",
)
def risk_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return global_rank(o, [("o_totalprice", True), ("o_orderkey", False)], "risk_rank")


@query(
    "top_k_per_tier",
    f"""WITH {SCORED}, r AS (SELECT student_id, risk, {_TIER} AS tier, row_number() OVER (ORDER BY risk DESC, student_id) AS risk_rank
          FROM scored), t AS (SELECT *, CAST(row_number() OVER (PARTITION BY tier ORDER BY risk DESC, student_id) AS INT) AS tier_rank FROM r)
        SELECT student_id, round(risk, 6) AS risk, tier, tier_rank, risk_rank FROM t WHERE tier_rank <= 50""",
)
def top_k_per_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stage(scored_students(spark, sf_dir).select("student_id", "risk"))
    return rounded(actions.top_per_tier(s, "risk", "student_id"))


# ------------------------------------------------------------------ drivers

_MEANS = ", ".join(f"avg(coalesce(CAST(\"{c}\" AS DOUBLE), 0)) AS m{i}" for i, c in enumerate(COEFFICIENTS))


# the texts stand here once more, so that a change of the rules or of their order shows
_ROW_ACTION = """CASE
  WHEN contains(lower(feature), 'grade') OR contains(lower(feature), 'approved')
    THEN 'Schedule tutoring sessions; recommend study groups'
  WHEN contains(lower(feature), 'tuition') OR contains(lower(feature), 'fee')
    THEN 'Provide financial aid guidance; offer payment plan options'
  WHEN contains(lower(feature), 'debtor') THEN 'Refer to financial counseling; explore debt restructuring options'
  WHEN contains(lower(feature), 'evaluation')
    THEN 'Encourage attendance and assignment completion; provide structured check-ins'
  WHEN contains(lower(feature), 'age') THEN 'Connect with support resources for non-traditional students'
  ELSE 'Schedule an advisor consultation' END"""
_SYSTEM_ACTION = """CASE
  WHEN contains(lower(feature), 'tuition') OR contains(lower(feature), 'fee')
    THEN 'Establish emergency financial aid funding and improve payment flexibility'
  WHEN contains(lower(feature), 'scholarship') THEN 'Expand scholarship funding and eligibility review'
  WHEN contains(lower(feature), 'grade') OR contains(lower(feature), 'approved')
    THEN 'Strengthen academic support programs and targeted tutoring'
  WHEN contains(lower(feature), 'evaluation')
    THEN 'Review assessment practices and provide structured learning supports'
  ELSE 'Monitor the factor and evaluate targeted interventions' END"""


_CONTRIBUTIONS = f"""{SCORED}, means AS (SELECT {_MEANS} FROM scored), contributions AS (""" + " UNION ALL ".join(
    f"SELECT student_id, risk, '{c}' AS feature, coalesce(CAST(\"{c}\" AS DOUBLE), 0) AS value, "
    f"(coalesce(CAST(\"{c}\" AS DOUBLE), 0) - m{i}) * ({w})::DOUBLE AS contribution FROM scored CROSS JOIN means"
    for i, (c, w) in enumerate(COEFFICIENTS.items())
) + ")"


def _explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stage(scored_students(spark, sf_dir).select("student_id", "risk", "Course", *[col(c) for c in COEFFICIENTS]))
    return attribution.linear_contributions(s, COEFFICIENTS)


@query(
    "linear_contributions",
    f"""WITH {_CONTRIBUTIONS} SELECT student_id, feature, round(value, 6) AS value, round(contribution, 6) AS contribution
        FROM contributions""",
)
def linear_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_explained(spark, sf_dir).select("student_id", F.inline("contributions")))


@query(
    "top_drivers",
    f"""WITH {_CONTRIBUTIONS}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY student_id ORDER BY abs(contribution) DESC, feature) AS INT)
          AS place FROM contributions)
        SELECT student_id, place, feature, round(value, 6) AS value, round(contribution, 6) AS contribution,
          {_ROW_ACTION} AS action, {_ADVICE} AS overall_recommendation
        FROM r WHERE place <= 5""",
)
def top_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = actions.with_actions(attribution.top_drivers(_explained(spark, sf_dir), 5), "risk")
    rows = e.select("student_id", "overall_recommendation", F.posexplode("top_drivers").alias("i", "d"))
    return rounded(
        rows.select("student_id", (F.col("i") + 1).alias("place"), "d.*", "overall_recommendation")
    )


_GLOBAL = f"""{_CONTRIBUTIONS}, g AS (SELECT feature, avg(abs(contribution)) AS mean_abs FROM contributions GROUP BY feature),
  ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY mean_abs DESC, feature) AS INT) AS rank FROM g)"""


@query(
    "global_drivers",
    f"""WITH {_GLOBAL} SELECT rank, feature, round(mean_abs, 6) AS mean_abs,
          round(mean_abs / (SELECT max(mean_abs) FROM g), 6) AS bar_share,
          {_SYSTEM_ACTION} AS policy_action FROM ranked WHERE rank <= 10""",
)
def global_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = attribution.global_drivers(_explained(spark, sf_dir), COEFFICIENTS)
    return rounded(g.withColumn("policy_action", actions.system_action(F.col("feature"))))


@query(
    "strategic_recommendations",
    f"""WITH {_GLOBAL}, f AS (SELECT count(*) FILTER (WHERE regexp_matches(lower(feature), 'tuition|fee|scholarship|debtor')) AS money,
          count(*) FILTER (WHERE regexp_matches(lower(feature), 'grade|approved|evaluation|curricular')) AS study
          FROM ranked WHERE rank <= 3)
        SELECT 'Financial Support' AS domain, 'Critical' AS priority, 'Strengthen financial support pathways' AS action FROM f WHERE money > 0
        UNION ALL SELECT 'Academic Support', 'High', 'Expand tutoring and academic success programs' FROM f WHERE study > 0
        UNION ALL SELECT 'Monitoring', 'Medium', 'Continue monitoring and refine intervention criteria' FROM f
          WHERE money = 0 AND study = 0""",
)
def strategic_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.strategic_recommendations(attribution.global_drivers(_explained(spark, sf_dir), COEFFICIENTS))


# ------------------------------------------------------------------ cohorts

_NAMES = "CASE cohort_id " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in student.COURSE_NAMES.items()) + " ELSE 'Course ' || cohort_id END"
_PRIORITY = "CASE WHEN avg_risk > 0.6 THEN 'Critical' WHEN avg_risk > 0.4 THEN 'High' WHEN avg_risk > 0.25 THEN 'Medium' ELSE 'Low' END"


@query(
    "cohort_risk",
    f"""WITH {SCORED}, c AS (SELECT "Course" AS cohort_id, count(*) AS n, avg(risk) AS avg_risk FROM scored GROUP BY "Course"),
        p AS (SELECT *, {_PRIORITY} AS priority FROM c)
        SELECT 'Course' AS cohort_type, cohort_id, {_NAMES} AS cohort_name, n, priority, round(avg_risk, 6) AS avg_risk,
          CASE priority WHEN 'Critical' THEN 'Immediate intervention: assign dedicated advisor and increase TA support'
            WHEN 'High' THEN 'Increase TA support and monitor weekly'
            WHEN 'Medium' THEN 'Monitor closely and provide supplemental resources'
            WHEN 'Low' THEN 'Maintain current support level' END AS recommended_action FROM p""",
)
def cohort_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_students(spark, sf_dir).select("Course", "risk")
    return rounded(cohorts.cohort_risk(s, "Course", "risk", student.COURSE_NAMES))


_RADAR_FEATURES = list(dict.fromkeys(f for fs in student.RADAR_DIMENSIONS.values() for f in fs))


def _scaled(f: str) -> str:
    i = _RADAR_FEATURES.index(f)
    x = f'("{f}" - lo{i}) / (hi{i} - lo{i})'
    return f"1 - {x}" if f in student.RADAR_INVERTED else x


_RADAR = (
    f"WITH {STUDENTS}, ends AS (SELECT "
    + ", ".join(f'min("{f}") AS lo{i}, max("{f}") AS hi{i}' for i, f in enumerate(_RADAR_FEATURES))
    + " FROM students), per AS ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, {no} AS no, '{d}' AS dimension, \"{a}\" AS g, round(("
        + " + ".join(f"avg({_scaled(f)})" for f in fs)
        + f") / {len(fs)}, 2) AS s FROM students CROSS JOIN ends GROUP BY \"{a}\""
        for a in student.RADAR_GROUPS
        for no, (d, fs) in enumerate(student.RADAR_DIMENSIONS.items())
    )
    + """), pairs AS (SELECT attribute, no, dimension, min(s) FILTER (WHERE g = 0) AS group_0, min(s) FILTER (WHERE g = 1) AS group_1
        FROM per GROUP BY ALL),
      d AS (SELECT *, round(group_1 - group_0, 2) AS difference FROM pairs),
      m AS (SELECT *, row_number() OVER (PARTITION BY attribute ORDER BY abs(difference) DESC, no) AS r FROM d),
      b AS (SELECT attribute, difference AS top FROM m WHERE r = 1)
    SELECT m.attribute, dimension, group_0, group_1, difference, CASE WHEN r = 1 THEN 1 ELSE 0 END AS largest_gap,
      CASE WHEN top > 0 THEN 'group_1' ELSE 'group_0' END AS stronger_group FROM m JOIN b ON m.attribute = b.attribute"""
)


@query("cohort_radar", _RADAR)
def cohort_radar(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = [*student.RADAR_GROUPS, *_RADAR_FEATURES]
    s = stage(student_records(spark, sf_dir).select(*[col(c) for c in needed]))
    return cohorts.cohort_radar(s, student.RADAR_GROUPS, student.RADAR_DIMENSIONS, student.RADAR_INVERTED)


# ------------------------------------------------------------------ scenarios

FEATURES = list(COEFFICIENTS)
_WHAT_IF_SQL = {
    "Academic Support": {G2: f'"{G2}" + 10', E2: f'"{E2}" + 5'},
    "Financial Support": {"Tuition fees up to date": "1", "Debtor": "0"},
}
_OUTCOMES = f"{SCORED}, outcomes AS (" + " UNION ALL ".join(
    f"SELECT student_id, '{name}' AS scenario, risk AS baseline_risk, {_risk(values)} AS new_risk FROM scored"
    for name, values in _WHAT_IF_SQL.items()
) + ")"


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenarios.what_if(scored_students(spark, sf_dir), "student_id", "risk", FEATURES, student.what_if_scenarios(FEATURES)[:2], _scorer)


@query(
    "what_if",
    f"""WITH {_OUTCOMES} SELECT student_id, scenario, round(baseline_risk, 6) AS baseline_risk, round(new_risk, 6) AS new_risk,
        round(baseline_risk - new_risk, 6) AS risk_reduction,
        round((baseline_risk - new_risk) / baseline_risk * 100, 6) AS reduction_pct FROM outcomes""",
)
def what_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, not one example."""
    return rounded(_outcomes(spark, sf_dir))


@query(
    "best_scenario",
    f"""WITH {_OUTCOMES}, r AS (SELECT student_id, scenario, baseline_risk - new_risk AS gain,
          row_number() OVER (PARTITION BY student_id ORDER BY baseline_risk - new_risk DESC, scenario) AS r FROM outcomes)
        SELECT student_id, scenario, round(gain, 6) AS risk_reduction FROM r WHERE r = 1""",
)
def best_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scenarios.best_scenario(_outcomes(spark, sf_dir), "student_id"))


AID = "Clear debt of high-risk debtors"
NUDGE = "Raise engagement and achievement of all high-risk rows"
_POLICY_SQL = {
    "Financial Aid Program": (
        AID, "risk > 0.7 AND \"Debtor\" = 1", "2000.0 * e",
        {"Debtor": "0", "Tuition fees up to date": "1"},
    ),
    "Engagement Nudge System": (
        NUDGE, "risk > 0.7", "500.0",
        {E2: f'"{E2}" + 6', A2: f'"{A2}" + 4', G2: f'round_even(CASE WHEN "{G2}" + 5 > 20 THEN 20 ELSE "{G2}" + 5 END, 0)'},
    ),
}


@query(
    "policy_simulation",
    f"WITH {SCORED}, base AS (SELECT count(*) AS n, count(*) FILTER (WHERE risk > 0.5) AS p, count(*) FILTER (WHERE risk > 0.7) AS h FROM scored), "
    + "after AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS scenario, '{text}' AS description, count(*) FILTER (WHERE {on}) AS e, "
        f"count(*) FILTER (WHERE CASE WHEN {on} THEN {_risk(values)} ELSE risk END > 0.5) AS bad FROM scored"
        for name, (text, on, _, values) in _POLICY_SQL.items()
    )
    + "), costed AS ("
    + " UNION ALL ".join(
        f"SELECT *, ({cost})::DOUBLE AS total_cost FROM after WHERE scenario = '{name}'"
        for name, (_, _, cost, _) in _POLICY_SQL.items()
    )
    + """) SELECT scenario, description, e AS beneficiaries, total_cost, p - bad AS prevented,
        round(CASE WHEN p - bad > 0 THEN total_cost / (p - bad) END, 6) AS cost_per_save, round(bad / n, 6) AS new_rate,
        round(p / n, 6) AS baseline_rate, n AS total_rows, h AS high_risk_rows FROM costed CROSS JOIN base""",
)
def policy_simulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stage(scored_students(spark, sf_dir).select("student_id", "risk", *[col(c) for c in FEATURES]))
    return rounded(scenarios.policy_simulation(s, "risk", FEATURES, student.policies(F.col("risk") > 0.7), _scorer))
