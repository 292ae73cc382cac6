"""Intake: schemas, structural checks, drift, audits, missing values, outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.catalog.fixtures import (
    GAPPY_ORDERS,
    STUDENTS,
    WEEKLY_EVENTS,
    gappy_orders,
    student_records,
    weekly_events,
)
from riskloom.catalog.registry import query, rounded
from riskloom.functions.expr import col, number
from riskloom.operators import drift, missing, outliers, quality, schema
from riskloom.plans import rules as R
from riskloom.plans import student
from riskloom.plans.intake import clip_negatives
from riskloom.session import stage
from riskloom.sources.batches import json_records
from riskloom.sources.tables import table

# ------------------------------------------------------------------ schema

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("amount", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("channel", T.StringType()),
    ]
)


@query(
    "coerce_schema",
    """SELECT event_id,
         CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 4 = 0 THEN event_id % 50 END AS amount,
         event_type, CAST(NULL AS VARCHAR) AS channel
       FROM events""",
)
def coerce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    raw = e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("event_id") % 4 == 0, (F.col("event_id") % 50).cast("string"))
        .when(F.col("event_id") % 4 == 1, "12.5")
        .otherwise("many")
        .alias("amount"),
        "event_type",
        "props",
    )
    return schema.coerce_to_schema(raw, EVENT_SCHEMA)


@query(
    "stack_batches",
    """SELECT CAST(1 AS INT) AS batch, o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS status,
         CAST(NULL AS VARCHAR) AS note FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
       UNION ALL
       SELECT 2, o_orderkey, o_totalprice, NULL, o_orderpriority FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-01-01'""",
)
def stack_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    first = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    one = o.where(first).select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status")
    )
    two = o.where(~first).select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("note")
    )
    return schema.stack_batches({1: one, 2: two})


@query(
    "schema_contract",
    """SELECT * FROM (VALUES (1::INT, 'event_id', 'bigint'), (2, 'event_type', 'string'), (3, 'value', 'double'), (4, 'year', 'int'))
         AS c(position, "column", type)""",
)
def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first batch fixes, as written beside the batches and read back."""
    contract = schema.infer_schema(_event_batches(spark, sf_dir)[1])
    kept = stage(schema.contract_rows(spark, contract), "contract")
    return schema.contract_rows(spark, schema.read_contract(kept))


def _event_batches(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """Typed events; then all text, with a column too many; then one column short and words for numbers."""
    e = table(spark, sf_dir, "events")
    year = F.year("ts")
    part = F.col("event_id") % 3
    return {
        1: e.where(part == 0).select("event_id", "event_type", "value", year.alias("year")),
        2: e.where(part == 1).select(
            *[F.col(c).cast("string").alias(c) for c in ("value", "event_id")],
            year.cast("string").alias("year"),
            "event_type",
            "user_id",
        ),
        3: e.where(part == 2).select(
            "event_id",
            "event_type",
            F.when(F.col("event_id") % 2 == 0, F.col("value").cast("string")).otherwise("none").alias("value"),
        ),
    }


@query(
    "batches_by_contract",
    """SELECT CAST(event_id % 3 + 1 AS INT) AS batch, event_id, event_type,
         CASE WHEN event_id % 3 < 2 OR event_id % 2 = 0 THEN value END AS value,
         CASE WHEN event_id % 3 < 2 THEN CAST(year(ts) AS INT) END AS year FROM events""",
)
def batches_by_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.batches_by_contract(_event_batches(spark, sf_dir))


@query(
    "schema_difference",
    """SELECT 'extra' AS side, column_name, rows_seen FROM
         (SELECT 'o_orderpriority' AS column_name, count(o_orderpriority) AS rows_seen FROM orders)
       UNION ALL SELECT 'missing', 'o_clerk', count(*) FROM orders""",
)
def schema_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns a later batch has too many or too few, with the rows concerned."""
    o = table(spark, sf_dir, "orders")
    wanted = T.StructType([f for f in o.schema if f.name != "o_orderpriority"]).add("o_clerk", "string")
    diff = schema.schema_difference(o, wanted)
    sides = [
        F.struct(F.lit("extra").alias("side"), F.lit(c).alias("column_name"), F.count(col(c)).alias("rows_seen"))
        for c in diff["extra"]
    ] + [
        F.struct(F.lit("missing").alias("side"), F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("rows_seen"))
        for c in diff["missing"]
    ]
    return o.agg(F.array(*sides).alias("s")).select(F.inline("s"))


@query(
    "dtype_summary",
    """SELECT 'bigint' AS dtype, CAST(3 AS BIGINT) AS n_cols, 'l_orderkey,l_partkey,l_suppkey' AS columns,
         CAST(3 * count(*) AS BIGINT) AS known_cells FROM lineitem
       UNION ALL SELECT 'int', 1, 'l_linenumber', count(*) FROM lineitem
       UNION ALL SELECT 'double', 4, 'l_discount,l_extendedprice,l_quantity,l_tax', 4 * count(*) FROM lineitem
       UNION ALL SELECT 'string', 2, 'l_linestatus,l_returnflag', 2 * count(*) FROM lineitem
       UNION ALL SELECT 'timestamp_ntz', 1, 'l_shipdate', count(*) FROM lineitem""",
)
def dtype_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.dtype_summary(table(spark, sf_dir, "lineitem"))


def _type_sql(name: str, kind: str, source: str) -> str:
    if kind == "text":
        return f"SELECT '{name}' AS \"column\", 'categorical_text' AS var_type"
    whole = "TRUE" if kind == "int" else "FALSE"
    return (
        f"SELECT '{name}' AS \"column\", CASE WHEN count(\"{name}\") = 0 THEN 'categorical_text' "
        f"WHEN count(DISTINCT \"{name}\") <= 2 AND count(*) FILTER (WHERE \"{name}\" NOT IN (0, 1)) = 0 THEN 'binary' "
        f"WHEN {whole} AND count(DISTINCT \"{name}\") <= 20 THEN 'categorical_code' "
        f"ELSE 'continuous' END AS var_type FROM {source}"
    )


_GAPPY_KINDS = {
    "o_orderkey": "int",
    "o_custkey": "int",
    "o_orderstatus": "text",
    "price": "real",
    "priority": "text",
    "level": "int",
    "urgent": "int",
}


@query(
    "column_types",
    f"WITH {GAPPY_ORDERS} " + " UNION ALL ".join(_type_sql(c, k, "gappy") for c, k in _GAPPY_KINDS.items()),
)
def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.column_types(gappy_orders(spark, sf_dir))


@query(
    "columns_by_type",
    f"""WITH {GAPPY_ORDERS}, kinds AS ({" UNION ALL ".join(_type_sql(c, k, "gappy") for c, k in _GAPPY_KINDS.items())})
        SELECT var_type, string_agg("column", ',' ORDER BY "column") AS columns, count(*) AS n_columns
        FROM kinds WHERE "column" <> 'o_orderstatus' GROUP BY var_type""",
)
def columns_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = schema.column_types(gappy_orders(spark, sf_dir), exclude=["o_orderstatus"])
    return kinds.groupBy("var_type").agg(
        F.array_join(F.array_sort(F.collect_list("column")), ",").alias("columns"),
        F.count(F.lit(1)).alias("n_columns"),
    )


@query(
    "clip_negative",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer",
)
def clip_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return clip_negatives(customers, ["c_acctbal"])


@query(
    "json_records",
    f"""WITH {GAPPY_ORDERS} SELECT o_orderkey, '{{"o_orderkey":' || o_orderkey || ',"priority":' ||
          coalesce('"' || priority || '"', 'null') || ',"level":' || coalesce(CAST(level AS VARCHAR), 'null') || '}}' AS record
        FROM gappy""",
)
def json_records_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = gappy_orders(spark, sf_dir)
    return json_records(o.select("o_orderkey", "priority", "level"), keep=["o_orderkey"])


# ------------------------------------------------------------------ structure and outcome

_EVENT_CELLS = "user_id, event_type, value"


def _basic_sql(by: str | None) -> str:
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""WITH {WEEKLY_EVENTS},
      cells AS (SELECT week, user_id % 5 AS user_band, event_type, round(value, -1) AS value_band FROM weekly),
      copies AS (SELECT {key} user_band, event_type, value_band, count(*) AS n FROM cells
        GROUP BY {key} user_band, event_type, value_band),
      sums AS (SELECT {key} CAST(sum(n) AS BIGINT) AS "rows", CAST(3 AS INT) AS cols,
        CAST(sum(n * ((user_band IS NULL)::INT + (event_type IS NULL)::INT + (value_band IS NULL)::INT)) AS BIGINT)
          AS missing_cells, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM copies {group})
      SELECT *, round(missing_cells * 100.0 / ("rows" * cols), 6) AS missing_cell_pct,
        CASE WHEN missing_cells > 0 THEN 'Yes' ELSE 'No' END AS has_missing,
        CASE WHEN duplicate_rows > 0 THEN 'Yes' ELSE 'No' END AS has_duplicates FROM sums"""


def _event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_events(spark, sf_dir).select(
        "week", (F.col("user_id") % 5).alias("user_band"), "event_type", F.round("value", -1).alias("value_band")
    )


@query("basic_check", _basic_sql(None))
def basic_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.basic_check(_event_cells(spark, sf_dir).drop("week")))


@query("basic_check_weekly", _basic_sql("week"))
def basic_check_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.basic_check(_event_cells(spark, sf_dir), ["week"]))


@query(
    "repeated_rows",
    """WITH l AS (SELECT l_returnflag, l_linestatus, l_quantity, CASE WHEN l_linenumber % 2 = 0 THEN l_discount END AS d FROM lineitem)
       SELECT l_returnflag, l_linestatus, l_quantity, d, count(*) AS _n FROM l GROUP BY ALL HAVING count(*) > 1""",
)
def repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_discount")).alias("d")
    return quality.repeated_rows(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", half))


@query(
    "basic_check_lineitem",
    """WITH copies AS (SELECT *, count(*) AS n FROM lineitem GROUP BY ALL)
       SELECT CAST(sum(n) AS BIGINT) AS "rows", CAST(11 AS INT) AS cols, CAST(0 AS BIGINT) AS missing_cells,
         CAST(0 AS DOUBLE) AS missing_cell_pct, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, 'No' AS has_missing,
         CASE WHEN sum(n - 1) > 0 THEN 'Yes' ELSE 'No' END AS has_duplicates FROM copies""",
)
def basic_check_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.basic_check(table(spark, sf_dir, "lineitem")))


@query(
    "outcome_distribution",
    f"""WITH {WEEKLY_EVENTS} SELECT event_type, count(*) AS "count",
        round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM weekly GROUP BY event_type""",
)
def outcome_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.outcome_distribution(weekly_events(spark, sf_dir), "event_type"))


@query(
    "outcome_distribution_weekly",
    f"""WITH {WEEKLY_EVENTS} SELECT week, event_type, count(*) AS "count",
        round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY week), 6) AS pct
        FROM weekly GROUP BY week, event_type""",
)
def outcome_distribution_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.outcome_distribution(weekly_events(spark, sf_dir), "event_type", ["week"]))


# ------------------------------------------------------------------ drift

_DRIFT_COUNTS = f"""WITH {WEEKLY_EVENTS},
  n AS (SELECT week, event_type, count(*) AS n FROM weekly
    WHERE event_type IS NOT NULL GROUP BY week, event_type),
  w AS (SELECT week, sum(n) AS total, row_number() OVER (ORDER BY week) AS no FROM n GROUP BY week),
  grid AS (SELECT w.week, w.no, w.total, t.event_type, coalesce(n.n, 0) AS n
    FROM w CROSS JOIN (SELECT DISTINCT event_type FROM n) t LEFT JOIN n ON n.week = w.week AND n.event_type = t.event_type)"""

DRIFT_LAST = (
    _DRIFT_COUNTS
    + """, s AS (SELECT week, no, event_type, n * 100.0 / total AS this_pct,
        lag(n * 100.0 / total) OVER (PARTITION BY event_type ORDER BY no) AS last_pct FROM grid)
  SELECT week, event_type, round(this_pct, 6) AS this_pct, round(last_pct, 6) AS last_pct,
    round(this_pct - last_pct, 6) AS delta_pct FROM s WHERE no > 1 AND (this_pct > 0 OR last_pct > 0)"""
)

DRIFT_CUMULATIVE = (
    _DRIFT_COUNTS
    + """, s AS (SELECT week, no, event_type, n * 100.0 / total AS this_pct,
        sum(n) OVER (PARTITION BY event_type ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior,
        sum(total) OVER (PARTITION BY event_type ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_total
        FROM grid)
  SELECT week, event_type, round(this_pct, 6) AS this_pct, round(prior * 100.0 / prior_total, 6) AS cum_pct,
    round(this_pct - prior * 100.0 / prior_total, 6) AS delta_pct FROM s
  WHERE no > 1 AND (this_pct > 0 OR prior > 0)"""
)


@query("weekly_outcome_drift", DRIFT_LAST)
def weekly_outcome_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(drift.drift_vs_previous(weekly_events(spark, sf_dir), "week", "event_type"))


@query("cumulative_drift", DRIFT_CUMULATIVE)
def cumulative_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(drift.drift_vs_cumulative(weekly_events(spark, sf_dir), "week", "event_type"))


@query(
    "compare_shares",
    """WITH a AS (SELECT o_orderpriority AS p, count(*) * 100.0 / sum(count(*)) OVER () AS s FROM orders
         WHERE o_orderstatus = 'F' GROUP BY 1),
       b AS (SELECT o_orderpriority AS p, count(*) * 100.0 / sum(count(*)) OVER () AS s FROM orders
         WHERE o_orderstatus <> 'F' GROUP BY 1)
       SELECT coalesce(a.p, b.p) AS o_orderpriority, round(coalesce(a.s, 0), 6) AS this_pct,
         round(coalesce(b.s, 0), 6) AS open_pct, round(coalesce(a.s, 0) - coalesce(b.s, 0), 6) AS delta_pct
       FROM a FULL OUTER JOIN b ON a.p = b.p""",
)
def compare_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    this, ref = o.where("o_orderstatus = 'F'"), o.where("o_orderstatus <> 'F'")
    return rounded(drift.compare_shares(this, ref, "o_orderpriority", "open"))


@query(
    "period_change",
    f"""WITH {WEEKLY_EVENTS}, m AS (SELECT week, avg(value) AS score, count(*) AS n FROM weekly GROUP BY week)
        SELECT week, n, round(score, 6) AS score, round(score - lag(score) OVER (ORDER BY week), 6) AS change,
          CASE WHEN score < 49.5 THEN 1 ELSE 0 END AS alert FROM m""",
)
def period_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(drift.period_change(weekly_events(spark, sf_dir), "week", "value", 49.5))


# ------------------------------------------------------------------ audit

def _line_checks() -> list[R.Check]:
    return [
        R.Check("tax_over_discount", "INFO", ("l_tax", "l_discount"), col("l_tax") > col("l_discount"), "Tax > discount"),
        R.Check("small_quantity", "WARN", ("l_quantity",), number(col("l_quantity")) < 2, "Quantity < 2"),
        R.Check("negative_price", "FAIL", ("l_extendedprice",), number(col("l_extendedprice")) < 0, "Price < 0"),
        R.Check("dear_unit", "FAIL", ("l_extendedprice", "l_quantity"),
                col("l_extendedprice") > 50000 * col("l_quantity"), "Price per unit > 50000"),
        R.Check("no_clerk", "FAIL", ("l_clerk",), F.lit(True), "Column is absent, check is left out"),
    ]


_LINE_AUDIT = """SELECT 'tax_over_discount' AS check_name, 'INFO' AS severity, 2 AS severity_rank,
    count(*) AS affected_rows, 'Tax > discount' AS details{key} FROM lineitem WHERE l_tax > l_discount {group}
  UNION ALL SELECT 'small_quantity', 'WARN', 1, count(*), 'Quantity < 2'{key} FROM lineitem WHERE l_quantity < 2 {group}
  UNION ALL SELECT 'dear_unit', 'FAIL', 0, count(*), 'Price per unit > 50000'{key} FROM lineitem
    WHERE l_extendedprice > 50000 * l_quantity {group}"""


@query("integrity_audit", _LINE_AUDIT.format(key="", group=""))
def integrity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.by_severity(quality.integrity_audit(table(spark, sf_dir, "lineitem"), _line_checks()))


@query("integrity_audit_by_flag", _LINE_AUDIT.format(key=", l_returnflag", group="GROUP BY l_returnflag"))
def integrity_audit_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.integrity_audit(table(spark, sf_dir, "lineitem"), _line_checks(), ["l_returnflag"])


def _student_audit_sql() -> str:
    unit = "Curricular units {} sem ({})"
    rows = [
        ("age_too_low", "WARN", '"Age at enrollment" < 16', "Age < 16"),
        ("age_too_high", "WARN", '"Age at enrollment" > 80', "Age > 80"),
        ("approved_le_enrolled_sem1", "FAIL", f'"{unit.format("1st", "approved")}" > "{unit.format("1st", "enrolled")}"',
         "Approved units must not exceed enrolled units in Semester 1"),
        ("approved_le_enrolled_sem2", "FAIL", f'"{unit.format("2nd", "approved")}" > "{unit.format("2nd", "enrolled")}"',
         "Approved units must not exceed enrolled units in Semester 2"),
        ("tuition_vs_scholarship_review", "INFO", '"Tuition fees up to date" = 0 AND "Scholarship holder" = 1',
         "Scholarship=1 but tuition=0. Review: partial scholarship or payment timing?"),
        ("gdp_negative", "WARN", '"GDP" < 0', "GDP < 0 (data quality issue)"),
        ("inflation_negative", "WARN", '"Inflation rate" < 0', "Inflation rate < 0 (deflation or data issue)"),
        ("unemployment_negative", "WARN", '"Unemployment rate" < 0', "Unemployment rate < 0 (data quality issue)"),
        ("unemployment_extreme", "WARN", '"Unemployment rate" > 50', "Unemployment rate > 50% (check data)"),
    ]
    union = " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, '{s}' AS severity, {R.SEVERITIES.index(s)} AS severity_rank, "
        f"count(*) FILTER (WHERE {p}) AS affected_rows, '{d}' AS details FROM students"
        for n, s, p, d in rows
    )
    return f"WITH {STUDENTS}, hits AS ({union}) SELECT * FROM hits WHERE affected_rows > 0"


@query("student_audit", _student_audit_sql())
def student_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.by_severity(quality.integrity_audit(student_records(spark, sf_dir), student.checks()))


# ------------------------------------------------------------------ missing values

GAPPY_RULES = R.RuleSet(
    target="o_orderstatus",
    kinds={"level": R.COUNT},
    buckets=(("finance", frozenset(["urgent"])),),
    fill_rules=R.FILL_RULES,
)
_GAPPY_FILL = {
    "price": ("continuous_general", "indicator+median", "Continuous variable: use median and indicator"),
    "priority": ("continuous_general", "indicator+unknown", "Text category: fill with 'Unknown' and indicator"),
    "level": ("continuous_general", "indicator+zero", "Count variable: assume zero and indicator"),
    "urgent": ("finance", "indicator+assume_no", "Financial variable: assume 'No' (0) and indicator"),
}
_GAPPY_NULLS = "WITH " + GAPPY_ORDERS + ", gaps AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{b}' AS rule_bucket, '{s}' AS strategy, '{r.replace(chr(39), chr(39) * 2)}' AS rationale, "
    f"count(*) - count({c}) AS missing_count, count(*) AS n, count({c}) AS known FROM gappy"
    for c, (b, s, r) in _GAPPY_FILL.items()
) + ")"


@query(
    "missing_plan",
    _GAPPY_NULLS
    + """ SELECT "column", rule_bucket, missing_count, round(missing_count * 100.0 / n, 6) AS missing_pct, strategy,
         rationale FROM gaps WHERE missing_count > 0""",
)
def missing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = gappy_orders(spark, sf_dir)
    kinds = schema.classify_columns(o, GAPPY_RULES)
    return rounded(missing.missing_plan(o, GAPPY_RULES, kinds))


@query(
    "missing_summary",
    _GAPPY_NULLS
    + """ SELECT "column", missing_count, round(missing_count * 100.0 / n, 6) AS missing_pct,
         known AS non_missing_count FROM gaps WHERE missing_count > 0""",
)
def missing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(missing.missing_summary(gappy_orders(spark, sf_dir)))


@query(
    "impute_median",
    f"""WITH {GAPPY_ORDERS}, m AS (SELECT quantile_cont(price, 0.5) AS med FROM gappy)
        SELECT o_orderkey, round(coalesce(price, med), 6) AS price, CASE WHEN price IS NULL THEN 1 ELSE 0 END AS price__is_missing
        FROM gappy CROSS JOIN m""",
)
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = gappy_orders(spark, sf_dir).select("o_orderkey", "price")
    return rounded(missing.fit_fill(o, {"price": "indicator+median"}).transform(o))


@query(
    "impute_mode",
    f"""WITH {GAPPY_ORDERS}, m AS (SELECT level AS v FROM gappy WHERE level IS NOT NULL
          GROUP BY level ORDER BY count(*) DESC, level LIMIT 1)
        SELECT o_orderkey, CAST(coalesce(level, v) AS INT) AS level,
          CASE WHEN level IS NULL THEN 1 ELSE 0 END AS level__is_missing FROM gappy CROSS JOIN m""",
)
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = gappy_orders(spark, sf_dir).select("o_orderkey", "level")
    return missing.fit_fill(o, {"level": "indicator+mode"}).transform(o)


@query(
    "impute_constants",
    f"""WITH {GAPPY_ORDERS} SELECT o_orderkey, coalesce(priority, 'Unknown') AS priority,
          CAST(coalesce(level, 0) AS BIGINT) AS level, CAST(coalesce(urgent, 0) AS BIGINT) AS urgent,
          CASE WHEN priority IS NULL THEN 1 ELSE 0 END AS priority__is_missing,
          CASE WHEN level IS NULL THEN 1 ELSE 0 END AS level__is_missing,
          CASE WHEN urgent IS NULL THEN 1 ELSE 0 END AS urgent__is_missing FROM gappy""",
)
def impute_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = gappy_orders(spark, sf_dir).select("o_orderkey", "priority", "level", "urgent")
    strategies = {"priority": "indicator+unknown", "level": "indicator+zero", "urgent": "indicator+assume_no"}
    return missing.fit_fill(o, strategies).transform(o)


@query(
    "impute_by_plan",
    f"""WITH {GAPPY_ORDERS}, m AS (SELECT quantile_cont(price, 0.5) AS med FROM gappy)
        SELECT o_orderkey, o_orderstatus, round(coalesce(price, med), 6) AS price, coalesce(priority, 'Unknown') AS priority,
          CAST(coalesce(level, 0) AS BIGINT) AS level, CAST(coalesce(urgent, 0) AS BIGINT) AS urgent,
          CASE WHEN price IS NULL THEN 1 ELSE 0 END AS price__is_missing,
          CASE WHEN priority IS NULL THEN 1 ELSE 0 END AS priority__is_missing,
          CASE WHEN level IS NULL THEN 1 ELSE 0 END AS level__is_missing,
          CASE WHEN urgent IS NULL THEN 1 ELSE 0 END AS urgent__is_missing FROM gappy CROSS JOIN m""",
)
def impute_by_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = gappy_orders(spark, sf_dir).drop("o_custkey")
    kinds = schema.classify_columns(o, GAPPY_RULES)
    return rounded(missing.apply_plan(o, missing.missing_plan(o, GAPPY_RULES, kinds)))


@query(
    "missing_label_rate",
    """SELECT lang, count(*) AS n, count(*) - count(quality) AS unlabelled,
         round((count(*) - count(quality)) * 100.0 / count(*), 6) AS unlabelled_pct
       FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
)
def missing_label_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps left by an outer join, per group."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    out = joined.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality").isNull()).alias("unlabelled")
    )
    return rounded(out.withColumn("unlabelled_pct", F.col("unlabelled") * 100.0 / F.col("n")))


# ------------------------------------------------------------------ outliers

def _fences_sql(c: str, source: str, multiple: float = 3.0) -> str:
    return (
        f"SELECT q[1] - {multiple} * (q[2] - q[1]) AS lo, q[2] + {multiple} * (q[2] - q[1]) AS hi, q[2] - q[1] AS spread "
        f"FROM (SELECT quantile_cont({c}, [0.25, 0.75]) AS q FROM {source})"
    )


@query(
    "outlier_iqr",
    f"""WITH {WEEKLY_EVENTS}, f AS ({_fences_sql("value", "weekly")})
        SELECT event_id, value, CASE WHEN spread > 0 AND (value < lo OR value > hi) THEN 1 ELSE 0 END AS value__is_outlier
        FROM weekly CROSS JOIN f""",
)
def outlier_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.iqr_flags(weekly_events(spark, sf_dir).select("event_id", "value"), ["value"])


@query(
    "outlier_zscore",
    """WITH s AS (SELECT avg(n_chars) AS m, stddev_samp(n_chars) AS sd FROM documents)
       SELECT doc_id, n_chars, CASE WHEN abs((n_chars - m) / sd) > 4 THEN 1 ELSE 0 END AS n_chars__is_outlier
       FROM documents CROSS JOIN s""",
)
def outlier_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.zscore_flags(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), ["n_chars"])


_REPORT_COLUMNS = {"l_extendedprice": "unit", "l_quantity": "l_quantity", "l_discount": "l_discount"}
_UNIT = "l_extendedprice / l_quantity"


def _unit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax")).alias("rebate"),
        "l_quantity",
        "l_discount",
        F.col("l_tax").alias("tax_grade"),
    )


_UNIT_LINES = f"""lines AS (SELECT {_UNIT} AS unit_price, l_extendedprice * l_discount * l_tax AS rebate, l_quantity,
    l_discount FROM lineitem)"""
_UNIT_RULES = R.RuleSet(outlier_policies={"unit_price": R.Treatment("winsorize", "Unit price extremes are noise")})


def _report_sql(c: str, handling: str, why: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE spread > 0 AND ({c} < lo OR {c} > hi)) AS outlier_count, "
        f"count({c}) AS n, '{handling}' AS handling, '{why}' AS rationale, count(DISTINCT {c}) AS d "
        f"FROM lines CROSS JOIN ({_fences_sql(c, 'lines')}) f"
    )


@query(
    "outlier_report",
    f"""WITH {_UNIT_LINES}, r AS ({_report_sql("unit_price", "winsorize", "Unit price extremes are noise")}
        UNION ALL {_report_sql("rebate", "flag_only", "Default: Flag for monitoring without modification")}
        UNION ALL {_report_sql("l_quantity", "flag_only", "Default: Flag for monitoring without modification")})
        SELECT "column", outlier_count, round(outlier_count * 100.0 / n, 6) AS outlier_pct, handling, rationale
        FROM r WHERE d > 25 AND outlier_count > 0""",
)
def outlier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _unit_lines(spark, sf_dir)
    return rounded(outliers.outlier_report(lines, lines.columns, _UNIT_RULES))


@query(
    "winsorize",
    f"""WITH {WEEKLY_EVENTS}, q AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM weekly)
        SELECT event_id, round(CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END, 6) AS value
        FROM weekly CROSS JOIN q""",
)
def winsorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(outliers.winsorize(weekly_events(spark, sf_dir).select("event_id", "value"), ["value"]))


@query(
    "apply_outliers",
    f"""WITH {WEEKLY_EVENTS}, f AS ({_fences_sql("value", "weekly")}),
          q AS (SELECT quantile_cont(value, 0.01) AS a, quantile_cont(value, 0.99) AS b FROM weekly)
        SELECT event_id, round(CASE WHEN value < a THEN a WHEN value > b THEN b ELSE value END, 6) AS value,
          CASE WHEN spread > 0 AND (value < lo OR value > hi) THEN 1 ELSE 0 END AS value__is_outlier
        FROM weekly CROSS JOIN f CROSS JOIN q""",
)
def apply_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = weekly_events(spark, sf_dir).select("event_id", "value")
    noisy = R.RuleSet(outlier_policies={"value": R.Treatment("winsorize", "noise")})
    return rounded(outliers.apply_outliers(e, outliers.outlier_report(e, ["value"], noisy)))
