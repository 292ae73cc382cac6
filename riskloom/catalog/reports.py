"""Whole cleaning run and the tables behind the report pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.catalog.actions import _GLOBAL, COEFFICIENTS, INTERCEPT, SCORED
from riskloom.catalog.fixtures import STUDENTS, WEEKLY_EVENTS, student_records, weekly_events
from riskloom.catalog.intake import DRIFT_CUMULATIVE, DRIFT_LAST
from riskloom.catalog.registry import query, rounded
from riskloom.functions.expr import col
from riskloom.operators import actions, attribution, outcome
from riskloom.plans import intake, report, student
from riskloom.plans.rules import Check
from riskloom.session import stage

# ------------------------------------------------------------------ cleaning

_MACRO = ("Unemployment rate", "Inflation rate", "GDP")
_G1, _G2 = "Curricular units 1st sem (grade)", "Curricular units 2nd sem (grade)"
_MODE = """(SELECT "{c}" FROM students WHERE "{c}" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""
_MEDIAN = """(SELECT quantile_cont("{c}", 0.5) FROM students)"""


@query(
    "clean_students",
    f"""WITH {STUDENTS}, g AS (SELECT student_id, greatest("GDP", 0) AS g0 FROM students),
        q AS (SELECT quantile_cont(g0, [0.25, 0.75, 0.01, 0.99]) AS q FROM g),
        f AS (SELECT student_id, g0, q[3] AS a, q[4] AS b, q[1] - 3 * (q[2] - q[1]) AS lo, q[2] + 3 * (q[2] - q[1]) AS hi FROM g CROSS JOIN q)
        SELECT s.student_id, "Target",
          CASE WHEN "Target" IS NULL THEN 1 ELSE 0 END AS "Target__is_missing",
          coalesce(CAST("Mother's qualification" AS VARCHAR), 'Unknown') AS "Mother's qualification",
          CAST(coalesce("Debtor", 0) AS BIGINT) AS "Debtor",
          CASE WHEN "Debtor" IS NULL THEN 1 ELSE 0 END AS "Debtor__is_missing",
          round(coalesce("Admission grade", {_MEDIAN.format(c="Admission grade")}), 6) AS "Admission grade",
          CAST(coalesce("Previous qualification", {_MODE.format(c="Previous qualification")}) AS INT) AS "Previous qualification",
          round(coalesce("{_G1}", {_MEDIAN.format(c=_G1)}), 6) AS "{_G1}",
          round(coalesce("{_G2}", {_MEDIAN.format(c=_G2)}), 6) AS "{_G2}",
          greatest("Inflation rate", 0) AS "Inflation rate",
          round(CASE WHEN g0 < a THEN a WHEN g0 > b THEN b ELSE g0 END, 6) AS "GDP",
          CASE WHEN g0 < lo OR g0 > hi THEN 1 ELSE 0 END AS "GDP__is_outlier"
        FROM students s JOIN f ON s.student_id = f.student_id""",
)
def clean_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clip, fill, flag and winsorise the student records."""
    raw = stage(student_records(spark, sf_dir))
    done = intake.clean(raw, student.RULES, ["student_id", "batch"], _MACRO)
    shown = [
        "student_id", "Target", "Target__is_missing", "Mother's qualification", "Debtor", "Debtor__is_missing",
        "Admission grade", "Previous qualification", _G1, _G2, "Inflation rate", "GDP", "GDP__is_outlier",
    ]
    return rounded(done.table.select(*[col(c) for c in shown]))


@query(
    "student_missing_plan",
    f"""WITH {STUDENTS}, n AS ("""
    + " UNION ALL ".join(
        f"SELECT '{c.replace(chr(39), chr(39) * 2)}' AS \"column\", '{b}' AS rule_bucket, '{s}' AS strategy, "
        f"count(*) - count(\"{c}\") AS missing_count, count(*) AS n FROM students"
        for c, b, s in (
            ("Mother's qualification", "parent", "indicator+unknown"),
            ("Debtor", "finance", "indicator+assume_no"),
            ("Admission grade", "continuous_general", "indicator+median"),
            ("Previous qualification", "coded_categorical", "indicator+mode"),
            (_G1, "critical_academic", "indicator+median"),
            (_G2, "critical_academic", "indicator+median"),
            ("Target", "outcome", "indicator"),
        )
    )
    + """) SELECT "column", rule_bucket, missing_count, round(missing_count * 100.0 / n, 6) AS missing_pct, strategy
        FROM n WHERE missing_count > 0""",
)
def student_missing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.operators.missing import missing_plan

    s = student_records(spark, sf_dir).drop("student_id", "batch")
    return rounded(missing_plan(s, student.RULES, student.KINDS).drop("rationale"))


# ------------------------------------------------------------------ intake page

_PANEL_CHECK = "value > 250"


def _panel_sql() -> str:
    """Segments of the events; rows as (segment, block, item, metric, value)."""
    base = """, d AS (SELECT week, user_id, event_type, value FROM weekly),
      seg AS (SELECT week AS segment, user_id, event_type, value FROM d UNION ALL SELECT 'Overall', user_id, event_type, value FROM d),
      copies AS (SELECT segment, user_id, event_type, value, count(*) AS n FROM seg GROUP BY ALL),
      b AS (SELECT segment, sum(n) AS r, sum(n * ((user_id IS NULL)::INT + (event_type IS NULL)::INT + (value IS NULL)::INT)) AS m,
        sum(n - 1) AS dup FROM copies GROUP BY segment),
      o AS (SELECT segment, coalesce(event_type, 'missing') AS item, count(*) AS n FROM seg GROUP BY ALL),
      dl AS (""" + DRIFT_LAST.replace(f"WITH {WEEKLY_EVENTS},", "WITH", 1) + "), dc AS (" + DRIFT_CUMULATIVE.replace(
        f"WITH {WEEKLY_EVENTS},", "WITH", 1
    ) + ")"
    rows = [
        "SELECT segment, 'basic', 'all', unnest(['rows', 'cols', 'missing_cells', 'missing_cell_pct', 'duplicate_rows']), "
        "unnest([r, 3, m, m * 100.0 / (r * 3), dup]::DOUBLE[]) FROM b",
        "SELECT segment, 'outcome', item, unnest(['count', 'pct']), "
        "unnest([n, n * 100.0 / sum(n) OVER (PARTITION BY segment)]::DOUBLE[]) FROM o",
        "SELECT week, 'drift_last', event_type, unnest(['this_pct', 'last_pct', 'delta_pct']), unnest([this_pct, last_pct, delta_pct]::DOUBLE[]) FROM dl",
        "SELECT week, 'drift_cum', event_type, unnest(['this_pct', 'cum_pct', 'delta_pct']), unnest([this_pct, cum_pct, delta_pct]::DOUBLE[]) FROM dc",
        "SELECT segment, 'audit', 'high_value', unnest(['affected_rows', 'severity_rank']), unnest([count(*), 1]::DOUBLE[]) FROM seg "
        f"WHERE {_PANEL_CHECK} GROUP BY segment",
        f"SELECT segment, 'severity', 'WARN', unnest(['checks', 'affected_rows']), unnest([1, count(*)]::DOUBLE[]) FROM seg "
        f"WHERE {_PANEL_CHECK} GROUP BY segment",
        "SELECT DISTINCT segment, 'dtype', unnest(['bigint', 'string', 'double']), 'columns', 1.0 FROM seg",
        "SELECT segment, 'missing', item, unnest(['missing_count', 'missing_pct']), unnest([m, m * 100.0 / r]::DOUBLE[]) FROM ("
        "SELECT segment, unnest(['user_id', 'event_type', 'value']) AS item, "
        "unnest([count(*) - count(user_id), count(*) - count(event_type), count(*) - count(value)]) AS m, count(*) AS r "
        "FROM seg GROUP BY segment) WHERE m > 0",
    ]
    rows.append(
        "SELECT segment, 'outlier', 'value', unnest(['outlier_count', 'outlier_pct']), unnest([o, o * 100.0 / n]::DOUBLE[]) FROM ("
        "SELECT segment, count(value) AS n, count(*) FILTER (WHERE hi > lo AND (value < lo - 3 * (hi - lo) OR value > hi + 3 * (hi - lo))) AS o "
        "FROM seg CROSS JOIN (SELECT quantile_cont(value, 0.25) AS lo, quantile_cont(value, 0.75) AS hi FROM d) GROUP BY segment) WHERE o > 0"
    )
    union = " UNION ALL ".join(rows)
    return f"""WITH {WEEKLY_EVENTS}{base}, p(segment, block, item, metric, value) AS ({union})
      SELECT segment, block, item, metric, round(value, 6) AS value FROM p"""


@query("intake_panel", _panel_sql())
def intake_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = weekly_events(spark, sf_dir).select("week", "user_id", "event_type", "value")
    checks = [Check("high_value", "WARN", ("value",), F.col("value") > 250, "value > 250")]
    return rounded(intake.segment_panels(e, "week", "event_type", checks, measures=["value"]))


# ------------------------------------------------------------------ profile and slice pages

_BINARY = [c for cs in student.GROUPS.values() for c in cs if c in student.FLAGS]
_PLACE = {c: g for g, cs in student.GROUPS.items() for c in cs}


def _quoted(x: str) -> str:
    return x.replace("'", "''")


@query(
    "report_profile_binary",
    f"WITH {STUDENTS} "
    + " UNION ALL ".join(
        f"SELECT '{_PLACE[c]}' AS \"group\", '{c}' AS \"column\", round(avg(\"{c}\") * 100, 6) AS share_1_pct, "
        f"round(count(*) FILTER (WHERE \"{c}\" = 0) * 100.0 / count(*), 6) AS all_0_pct, "
        f"round(count(*) FILTER (WHERE \"{c}\" = 1) * 100.0 / count(*), 6) AS all_1_pct FROM students"
        for c in _BINARY
    ),
)
def report_profile_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = student_records(spark, sf_dir)
    return rounded(report.group_profiles(s, student.RULES, student.KINDS)["binary"])


_NUMBERS = [c for cs in student.GROUPS.values() for c in cs if c in student.MEASURES or c in student.COUNTS]


@query(
    "report_profile_continuous",
    f"WITH {STUDENTS} "
    + " UNION ALL ".join(
        f"SELECT '{_PLACE[c]}' AS \"group\", '{c}' AS \"column\", count(\"{c}\") AS \"count\", round(avg(\"{c}\"), 6) AS mean, "
        f"round(stddev_samp(\"{c}\"), 6) AS std, round(min(\"{c}\")::DOUBLE, 6) AS min, round(quantile_cont(\"{c}\", 0.25), 6) AS q25, "
        f"round(quantile_cont(\"{c}\", 0.5), 6) AS q50, round(quantile_cont(\"{c}\", 0.75), 6) AS q75, "
        f"round(max(\"{c}\")::DOUBLE, 6) AS max FROM students"
        for c in _NUMBERS
    ),
)
def report_profile_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stage(student_records(spark, sf_dir))
    return rounded(report.group_profiles(s, student.RULES, student.KINDS)["continuous"])


_CODES = [c for cs in student.GROUPS.values() for c in cs if c in student.CODES]


@query(
    "report_profile_categorical",
    f"WITH {STUDENTS}, v AS ("
    + " UNION ALL ".join(
        f"SELECT '{_PLACE[c]}' AS \"group\", '{_quoted(c)}' AS \"column\", CAST(\"{c}\" AS VARCHAR) AS value, count(*) AS \"count\" "
        f"FROM students GROUP BY \"{c}\""
        for c in _CODES
    )
    + """), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, value NULLS LAST) AS INT) AS rank FROM v)
        SELECT "group", "column", value, "count", rank, round("count" * 100.0 / (SELECT count(*) FROM students), 6) AS pct
        FROM r WHERE rank <= 10""",
)
def report_profile_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stage(student_records(spark, sf_dir))
    return rounded(report.group_profiles(s, student.RULES, student.KINDS)["categorical"])


def _slice_sql() -> str:
    parts = []
    for c in student.SLICE_COLUMNS:
        kind = student.KINDS[c]
        if c in student.FLAGS or c in student.CODES:
            for k in student.CLASSES:
                parts.append(
                    f"SELECT '{c}' AS \"column\", '{kind}' AS type, CAST(\"{c}\" AS VARCHAR) AS key, '{k}' AS metric, "
                    f"count(*) FILTER (WHERE t = '{k}') * 100.0 / count(*) AS value FROM s WHERE \"{c}\" IS NOT NULL GROUP BY \"{c}\""
                )
        else:
            for m, e in (
                ("count", "count(x)"), ("mean", "avg(x)"), ("std", "stddev_samp(x)"), ("min", "min(x)"), ("max", "max(x)"),
                ("q25", "quantile_cont(x, 0.25)"), ("q50", "quantile_cont(x, 0.5)"), ("q75", "quantile_cont(x, 0.75)"),
            ):
                expr = e.replace("x", f'"{c}"', 1) if e != "max(x)" else f'max("{c}")'
                parts.append(
                    f"SELECT '{c}', '{kind}', t, '{m}', ({expr})::DOUBLE FROM s GROUP BY t HAVING count(\"{c}\") > 0"
                )
    union = " UNION ALL ".join(parts)
    return f"""WITH {STUDENTS}, s AS (SELECT *, coalesce("Target", 'Unknown') AS t FROM students), p AS ({union})
        SELECT "column", type, key, metric, round(value, 6) AS value FROM p"""


@query("report_target_slices", _slice_sql())
def report_target_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing outcomes are a class of their own, ``Unknown``, as the label map makes them."""
    s = student_records(spark, sf_dir).withColumn(
        "Target", outcome.outcome_label(col("Target"), student.TARGET_LABELS)
    )
    s = stage(s.select("Target", *[col(c) for c in student.SLICE_COLUMNS]))
    shares, numbers = outcome.target_slices(s, student.SLICE_COLUMNS, "Target", student.CLASSES, student.KINDS)
    return rounded(report.slices_long(shares, numbers, "Target", student.CLASSES, student.KINDS))


# ------------------------------------------------------------------ action pages

_CONTRIB = _GLOBAL[: _GLOBAL.index(", g AS (SELECT feature, avg(abs(contribution))")]


@query(
    "report_tiers",
    f"""WITH {_CONTRIB}, best AS (SELECT student_id, feature AS top_factor FROM contributions
          QUALIFY row_number() OVER (PARTITION BY student_id ORDER BY abs(contribution) DESC, feature) = 1),
        t AS (SELECT student_id, risk, CASE WHEN risk > 0.7 THEN 'critical' WHEN risk >= 0.4 THEN 'warning' ELSE 'on_track' END AS tier FROM scored),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY tier ORDER BY risk DESC, student_id) AS INT) AS tier_rank FROM t)
        SELECT tier, tier_rank, r.student_id, round(risk, 6) AS risk, top_factor, CASE tier
          WHEN 'critical' THEN 'Immediate intervention recommended: contact within 48 hours'
          WHEN 'warning' THEN 'Proactive monitoring recommended: monthly check-ins'
          ELSE 'On track: maintain current support level' END AS overall_recommendation
        FROM r JOIN best ON r.student_id = best.student_id WHERE tier_rank <= 10""",
)
def report_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drivers are worked out for the listed rows only."""
    s = stage(student_records(spark, sf_dir).select("student_id", *[col(c) for c in COEFFICIENTS]))
    means = attribution.feature_means(s, COEFFICIENTS)
    top = actions.top_per_tier(attribution.logistic_score(s, COEFFICIENTS, INTERCEPT), "risk", "student_id")
    listed = attribution.top_drivers(attribution.linear_contributions(top, COEFFICIENTS, means))
    return rounded(report.tier_table(actions.with_actions(listed, "risk"), "student_id"))


@query(
    "report_missing",
    f"""WITH {STUDENTS}, n AS ("""
    + " UNION ALL ".join(
        f"SELECT '{_quoted(c)}' AS \"column\", count(*) - count(\"{c}\") AS missing_count, count(*) AS n FROM students"
        for c in ("Mother's qualification", "Debtor", "Admission grade", "Previous qualification", _G1, _G2, "Target")
    )
    + """) SELECT "column", missing_count, round(missing_count * 100.0 / n, 6) AS missing_pct FROM n WHERE missing_count > 0
        ORDER BY missing_count DESC, "column" LIMIT 5""",
)
def report_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five columns with most gaps."""
    from riskloom.operators.missing import missing_plan

    s = student_records(spark, sf_dir).drop("student_id", "batch")
    top = missing_plan(s, student.RULES, student.KINDS).limit(5)
    return rounded(top.select("column", "missing_count", "missing_pct"))


@query(
    "report_cohorts",
    f"""WITH {SCORED}, c AS (SELECT "Course" AS cohort_id, count(*) AS n, avg(risk) AS avg_risk FROM scored GROUP BY "Course")
        SELECT CAST(row_number() OVER (ORDER BY avg_risk DESC, cohort_id) AS INT) AS place, cohort_id, n, round(avg_risk, 6) AS avg_risk
        FROM c ORDER BY avg_risk DESC, cohort_id LIMIT 10""",
)
def report_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten riskiest cohorts, numbered."""
    from pyspark.sql import Window

    from riskloom.operators.cohorts import cohort_risk

    s = attribution.logistic_score(student_records(spark, sf_dir), COEFFICIENTS, INTERCEPT)
    best = cohort_risk(s.select("Course", "risk"), "Course", "risk", student.COURSE_NAMES).limit(10)
    # ten rows
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("avg_risk"), "cohort_id"))
    return rounded(best.select(place.alias("place"), "cohort_id", "n", "avg_risk"))
