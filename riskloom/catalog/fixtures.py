"""Derived input tables, built by Spark and, for the oracles, by SQL.

The column formulas are written once, as SQL text both engines read the same
way; the joins and aggregates are built separately for each engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.sources.tables import table

# ---------------------------------------------------------------- events by week

# value, outcome and user are unknown for some keys, so that gaps exist
EVENT_COLUMNS = {
    "event_id": "event_id",
    "user_id": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END",
    "event_type": "CASE WHEN event_id % 23 = 0 THEN NULL ELSE event_type END",
    "value": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END",
}


def weekly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their Monday as ``week``."""
    e = table(spark, sf_dir, "events")
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    return e.select(week.alias("week"), *[F.expr(x).alias(c) for c, x in EVENT_COLUMNS.items()])


WEEKLY_EVENTS = (
    "weekly AS (SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, "
    + ", ".join(f"{x} AS {c}" for c, x in EVENT_COLUMNS.items())
    + " FROM events)"
)

# ---------------------------------------------------------------- orders with gaps

ORDER_COLUMNS = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "o_custkey",
    "o_orderstatus": "o_orderstatus",
    "price": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END",
    "priority": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END",
    "level": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END",
    "urgent": "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END",
}


def gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(*[F.expr(x).alias(c) for c, x in ORDER_COLUMNS.items()])


GAPPY_ORDERS = (
    "gappy AS (SELECT " + ", ".join(f"{x} AS {c}" for c, x in ORDER_COLUMNS.items()) + " FROM orders)"
)

# ---------------------------------------------------------------- student records

COURSES = (33, 171, 8014, 9003, 9070, 9085, 9119, 9130, 9147, 9238, 9254, 9500, 9556, 9670, 9773, 9853, 9991)
SPLIT_DAY = "1998-04-25"

_COURSE = (
    "CASE "
    + " ".join(f"WHEN c_nationkey = {i} THEN {code}" for i, code in enumerate(COURSES))
    + " ELSE 9900 + c_nationkey END"
)


def _semester(s: str, n: int) -> dict[str, str]:
    unit = f"Curricular units {s} sem"
    return {
        f"{unit} (credited)": f"COALESCE(credited{n}, 0)",
        f"{unit} (enrolled)": f"COALESCE(enrolled{n}, 0)",
        f"{unit} (evaluations)": f"COALESCE(evaluations{n}, 0)",
        f"{unit} (approved)": f"COALESCE(approved{n}, 0) + CASE WHEN c_custkey % 83 = 0 THEN 30 ELSE 0 END",
        f"{unit} (grade)": f"grade{n}",
        f"{unit} (without evaluations)": f"COALESCE(waiting{n}, 0)",
    }


STUDENT_COLUMNS = {
    "student_id": "c_custkey",
    "batch": "CAST(1 + c_custkey % 3 AS INT)",
    "Age at enrollment": (
        "CAST(17 + (c_custkey * 7) % 40 + CASE WHEN c_custkey % 97 = 0 THEN 60"
        " WHEN c_custkey % 89 = 0 THEN -10 ELSE 0 END AS DOUBLE)"
    ),
    "Gender": "CAST(c_custkey % 2 AS INT)",
    "Marital status": "CAST(1 + c_custkey % 6 AS INT)",
    "Nacionality": "CAST(1 + c_nationkey AS INT)",
    "International": "CASE WHEN c_nationkey % 9 = 0 THEN 1 ELSE 0 END",
    "Educational special needs": "CASE WHEN c_nationkey % 12 = 5 THEN 1 ELSE 0 END",
    "Displaced": "CAST(c_nationkey % 2 AS INT)",
    "Mother's qualification": "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(1 + c_custkey % 44 AS INT) END",
    "Father's qualification": "CAST(1 + (c_custkey * 3) % 44 AS INT)",
    "Mother's occupation": "CAST(c_custkey % 12 AS INT)",
    "Father's occupation": "CAST((c_custkey * 5) % 200 AS INT)",
    "Debtor": "CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_acctbal < 1500 THEN 1 ELSE 0 END",
    "Tuition fees up to date": "CASE WHEN c_acctbal >= 1000 THEN 1 ELSE 0 END",
    "Scholarship holder": "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END",
    "Admission grade": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 95 + c_acctbal / 100 END",
    "Previous qualification (grade)": "100 + CAST((c_custkey * 37) % 900 AS DOUBLE) / 10",
    "Application mode": "CAST(1 + c_custkey % 18 AS INT)",
    "Application order": "CAST(c_custkey % 9 AS INT)",
    "Previous qualification": "CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(1 + (c_custkey * 5) % 43 AS INT) END",
    "Course": _COURSE,
    "Daytime/evening attendance": "CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END",
    **_semester("1st", 1),
    **_semester("2nd", 2),
    "Unemployment rate": "CAST(76 + (c_custkey * 13) % 97 AS DOUBLE) / 10",
    "Inflation rate": "CAST((c_custkey * 17) % 60 - 15 AS DOUBLE) / 10",
    "GDP": "CAST((c_custkey * 29) % 900 - 400 AS DOUBLE) / 100 + CASE WHEN c_custkey % 101 = 0 THEN 60 ELSE 0 END",
    "Target": (
        "CASE WHEN c_custkey % 19 = 0 OR COALESCE(enrolled1, 0) + COALESCE(enrolled2, 0) = 0 THEN NULL"
        " WHEN CAST(COALESCE(approved1, 0) + COALESCE(approved2, 0) AS DOUBLE)"
        " / (COALESCE(enrolled1, 0) + COALESCE(enrolled2, 0)) < 0.28 THEN 'Dropout'"
        " WHEN CAST(COALESCE(approved1, 0) + COALESCE(approved2, 0) AS DOUBLE)"
        " / (COALESCE(enrolled1, 0) + COALESCE(enrolled2, 0)) > 0.38 THEN 'Graduate' ELSE 'Enrolled' END"
    ),
}


def student_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, shaped like a student record, from two periods of orders.

    Lines are counted per order first, so the orders meet one row per order and
    both aggregates combine before their shuffle.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    early = F.col("o_orderdate") < F.lit(SPLIT_DAY).cast("timestamp_ntz")
    aggs = []
    for n, when in ((1, early), (2, ~early)):
        aggs += [
            F.count_if(when).alias(f"enrolled{n}"),
            F.count_if(when & (F.col("o_orderstatus") == "F")).alias(f"approved{n}"),
            F.count_if(when & (F.col("o_orderstatus") == "P")).alias(f"waiting{n}"),
            F.count_if(when & (F.col("o_orderpriority") == "1-URGENT")).alias(f"credited{n}"),
            F.sum(F.when(when, F.coalesce("n_lines", F.lit(0))).otherwise(0)).alias(f"evaluations{n}"),
            (F.avg(F.when(when, F.col("o_totalprice"))) / 25013).alias(f"grade{n}"),
        ]
    history = joined.groupBy("o_custkey").agg(*aggs)
    c = table(spark, sf_dir, "customer")
    wide = c.join(history, c.c_custkey == history.o_custkey, "left")
    return wide.select(*[F.expr(x).alias(name) for name, x in STUDENT_COLUMNS.items()])


def _history_sql() -> str:
    parts = []
    for n, when in ((1, f"o_orderdate < TIMESTAMP '{SPLIT_DAY}'"), (2, f"o_orderdate >= TIMESTAMP '{SPLIT_DAY}'")):
        parts += [
            f"count(*) FILTER (WHERE {when}) AS enrolled{n}",
            f"count(*) FILTER (WHERE {when} AND o_orderstatus = 'F') AS approved{n}",
            f"count(*) FILTER (WHERE {when} AND o_orderstatus = 'P') AS waiting{n}",
            f"count(*) FILTER (WHERE {when} AND o_orderpriority = '1-URGENT') AS credited{n}",
            f"CAST(coalesce(sum(n_lines) FILTER (WHERE {when}), 0) AS BIGINT) AS evaluations{n}",
            f"avg(o_totalprice) FILTER (WHERE {when}) / 25013 AS grade{n}",
        ]
    return ", ".join(parts)


STUDENTS = (
    "lines AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey), "
    f"history AS (SELECT o_custkey, {_history_sql()} FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey "
    "GROUP BY o_custkey), "
    "students AS (SELECT "
    + ", ".join(f'{x} AS "{name}"' for name, x in STUDENT_COLUMNS.items())
    + " FROM customer LEFT JOIN history ON c_custkey = o_custkey)"
)


def with_trajectory_sql() -> str:
    """CTE ``paths``: students plus the trajectory features."""

    def u(s: str, part: str) -> str:
        return f'"Curricular units {s} sem ({part})"'

    def rate(s: str, part: str) -> str:
        return f"CASE WHEN {u(s, 'enrolled')} > 0 THEN {u(s, part)} / {u(s, 'enrolled')} END"

    g1, g2 = u("1st", "grade"), u("2nd", "grade")
    return f"""rates AS (SELECT *, {g2} - {g1} AS "Delta_Grade",
        {rate('1st', 'approved')} AS "CR_Sem1", {rate('2nd', 'approved')} AS "CR_Sem2",
        {rate('1st', 'evaluations')} AS "EvalPressure_Sem1", {rate('2nd', 'evaluations')} AS "EvalPressure_Sem2",
        {rate('1st', 'without evaluations')} AS "GhostRate_Sem1",
        {rate('2nd', 'without evaluations')} AS "GhostRate_Sem2" FROM students),
      paths AS (SELECT *, "CR_Sem2" - "CR_Sem1" AS "Delta_CR",
        "EvalPressure_Sem2" - "EvalPressure_Sem1" AS "Delta_EvalPressure",
        "GhostRate_Sem2" - "GhostRate_Sem1" AS "Delta_GhostRate",
        CASE WHEN "Delta_Grade" > 0 THEN 1 ELSE 0 END AS "Grade_Improvement",
        CASE WHEN "Delta_Grade" < 0 THEN 1 ELSE 0 END AS "Grade_Decline",
        CASE WHEN "CR_Sem1" >= 0.9 AND "CR_Sem2" <= 0.6 THEN 1 ELSE 0 END AS "Completion_Collapse",
        CASE WHEN {g1} >= 9.5 AND {g2} < 9.5 THEN 1 ELSE 0 END AS "Fail_Crossing",
        CASE WHEN {g1} >= 9 AND {g1} <= 11 AND {g2} < 9 THEN 1 ELSE 0 END AS "Borderline_Collapse",
        CASE WHEN "GhostRate_Sem1" < 0.2 AND "GhostRate_Sem2" > 0.5 THEN 1 ELSE 0 END AS "Ghost_Worsening"
        FROM rates)"""


PATHS = STUDENTS + ", " + with_trajectory_sql()
