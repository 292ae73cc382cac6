"""Column profiles and outcome slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.catalog.fixtures import GAPPY_ORDERS, STUDENTS, gappy_orders, student_records
from riskloom.catalog.registry import query, rounded
from riskloom.functions.expr import col
from riskloom.operators import outcome, profile
from riskloom.plans import student
from riskloom.sources.tables import table

_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_STATUS = ("F", "O", "P")


def _share_sql(c: str, source: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", round(avg({c}) * 100, 6) AS share_1_pct, "
        f"round(count(*) FILTER (WHERE {c} = 0) * 100.0 / count(*), 6) AS all_0_pct, "
        f"round(count(*) FILTER (WHERE {c} = 1) * 100.0 / count(*), 6) AS all_1_pct FROM {source}"
    )


@query(
    "binary_share",
    f"""WITH {GAPPY_ORDERS}, b AS (SELECT urgent, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS filled FROM gappy)
        {_share_sql("urgent", "b")} UNION ALL {_share_sql("filled", "b")}""",
)
def binary_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = gappy_orders(spark, sf_dir).select(
        "urgent", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("filled")
    )
    return rounded(profile.binary_share(o, ["urgent", "filled"]))


def _describe_sql(c: str, source: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {key}'{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, "
        f"round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM {source}{group}"
    )


@query("describe_columns", " UNION ALL ".join(_describe_sql(c, "lineitem") for c in _NUMBERS))
def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.describe(table(spark, sf_dir, "lineitem"), _NUMBERS))


@query(
    "grouped_describe",
    f"WITH {GAPPY_ORDERS} " + " UNION ALL ".join(_describe_sql(c, "gappy", "o_orderstatus") for c in ("price", "level")),
)
def grouped_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(outcome.grouped_describe(gappy_orders(spark, sf_dir), ["price", "level"], "o_orderstatus"))


@query(
    "top_values",
    f"""WITH {GAPPY_ORDERS}, v AS (
          SELECT 'priority' AS "column", priority AS value, count(*) AS "count" FROM gappy GROUP BY priority
          UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM gappy GROUP BY o_custkey
          UNION ALL SELECT 'level', CASE level WHEN 1 THEN 'Urgent' WHEN 5 THEN 'Low' ELSE CAST(level AS VARCHAR) END,
            count(*) FROM gappy GROUP BY level),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, value NULLS LAST) AS INT) AS rank FROM v)
        SELECT "column", value, "count", rank, round("count" * 100.0 / (SELECT count(*) FROM gappy), 6) AS pct
        FROM r WHERE rank <= 10""",
)
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = gappy_orders(spark, sf_dir)
    return rounded(
        profile.top_values(o, ["priority", "o_custkey", "level"], labels={"level": {1: "Urgent", 5: "Low"}})
    )


_FREQUENT = ("l_returnflag", "l_linenumber", "l_quantity", "l_partkey", "l_hot")


@query(
    "frequent_values",
    """WITH l AS (SELECT * REPLACE (l_quantity::INT AS l_quantity), CASE WHEN l_orderkey % 5 = 0 THEN NULL WHEN l_orderkey % 2 = 0 THEN l_linenumber ELSE l_orderkey * 10 + l_linenumber END
          AS l_hot FROM lineitem), v AS ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS \"count\" FROM l GROUP BY {c}" for c in _FREQUENT
    )
    + """), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, value NULLS LAST) AS INT) AS rank FROM v)
        SELECT "column", value, "count", rank, round("count" * 100.0 / (SELECT count(*) FROM lineitem), 6) AS pct FROM r WHERE rank <= 5""",
)
def frequent_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few values, many equally rare ones, and a third of the rows on few values beside many rare ones."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    hot = F.when(order % 5 == 0, None).when(order % 2 == 0, line).otherwise(order * 10 + line)
    rows = table(spark, sf_dir, "lineitem").withColumn("l_hot", hot)
    rows = rows.withColumn("l_quantity", F.col("l_quantity").cast("int")).select(*_FREQUENT)
    return rounded(profile.frequent_values(rows, _FREQUENT, 5))


def _histogram_sql(c: str, source: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(b AS INT) AS bin, round(lo + b * (hi - lo) / 30, 6) AS low,
        round(lo + (b + 1) * (hi - lo) / 30, 6) AS high,
        (SELECT count(*) FROM {source} WHERE least(floor(({c} - lo) / ((hi - lo) / 30)), 29) = b) AS n
      FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM {source}) CROSS JOIN range(30) t(b)"""


@query("histogram", " UNION ALL ".join(_histogram_sql(c, "lineitem") for c in ("l_extendedprice", "l_quantity")))
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.histogram(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"]))


@query(
    "ecdf",
    """WITH p AS (SELECT range / 100 AS p FROM range(101)),
       q AS (SELECT quantile_cont(c_acctbal, [range / 100 FOR range IN range(101)]) AS q FROM customer)
       SELECT 'c_acctbal' AS "column", round(p, 6) AS p, round(q[CAST(round(p * 100) AS INT) + 1], 6) AS value
       FROM p CROSS JOIN q""",
)
def ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.ecdf(table(spark, sf_dir, "customer"), ["c_acctbal"]))


@query(
    "crosstab_pct",
    "WITH "
    + GAPPY_ORDERS
    + ' SELECT priority AS value, '
    + ", ".join(f"round(count(*) FILTER (WHERE o_orderstatus = '{s}') * 100.0 / count(*), 6) AS \"{s}\"" for s in (*_STATUS, "X"))
    + " FROM gappy WHERE priority IS NOT NULL GROUP BY priority",
)
def crosstab_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(outcome.crosstab_pct(gappy_orders(spark, sf_dir), "priority", "o_orderstatus", (*_STATUS, "X")))


@query(
    "outcome_labels",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Unknown' END AS outcome,
         CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS ordinal,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' ELSE o_orderpriority END AS priority,
         substr(o_orderpriority, 1, 3) AS axis_label FROM orders WHERE o_orderstatus IS NOT NULL""",
)
def outcome_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code lists: unlisted outcomes are Unknown, unlisted values stay, ordinal recode."""
    from riskloom.functions.expr import label_cut, mapped

    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isNotNull())
    return o.select(
        "o_orderkey",
        outcome.outcome_label(F.col("o_orderstatus"), {"F": "Filled", "O": "Open"}).alias("outcome"),
        mapped(F.col("o_orderstatus"), {"F": 0, "O": 1, "P": 2}).alias("ordinal"),
        outcome.value_label(F.col("o_orderpriority"), {"1-URGENT": "Urgent"}).alias("priority"),
        label_cut(F.col("o_orderpriority"), 3).alias("axis_label"),
    )


@query(
    "lookup_labels",
    """SELECT s_suppkey, coalesce(n_name, 'Nation ' || s_nationkey) AS nation
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def lookup_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code to name by a lookup table, with a default made from the code."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    name = F.coalesce("n_name", F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")))
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select("s_suppkey", name.alias("nation"))


@query(
    "box_stats",
    f"""WITH {GAPPY_ORDERS}, b AS (SELECT o_orderstatus, count(price) AS n, quantile_cont(price, 0.25) AS q1,
          quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3 FROM gappy GROUP BY o_orderstatus),
        v AS (SELECT g.o_orderstatus, price, n, q1, median, q3,
          price BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1) AS inside
          FROM gappy g JOIN b ON g.o_orderstatus = b.o_orderstatus WHERE price IS NOT NULL)
        SELECT o_orderstatus, 'price' AS "column", n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
          min(price) FILTER (WHERE inside) AS whisker_low, max(price) FILTER (WHERE inside) AS whisker_high,
          count(*) FILTER (WHERE NOT inside) AS fliers FROM v GROUP BY ALL""",
)
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(outcome.box_stats(gappy_orders(spark, sf_dir), ["price"], "o_orderstatus", whisker=0.5))


_CLASSES = ", ".join(
    f"round(count(*) FILTER (WHERE \"Target\" = '{k}') * 100.0 / count(*), 6) AS \"{k}\"" for k in student.CLASSES
)


@query(
    "student_crosstab",
    f"""WITH {STUDENTS} SELECT CAST("Scholarship holder" AS VARCHAR) AS value, {_CLASSES} FROM students
        WHERE "Target" IS NOT NULL GROUP BY "Scholarship holder" """,
)
def student_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = student_records(spark, sf_dir).select("Scholarship holder", "Target")
    return rounded(outcome.crosstab_pct(s, "Scholarship holder", "Target", student.CLASSES))


@query(
    "distinct_groups",
    """SELECT 'o_orderpriority' AS attribute, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS groups,
         count(DISTINCT o_orderpriority) AS n_groups FROM orders
       UNION ALL SELECT 'o_orderstatus', string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus),
         count(DISTINCT o_orderstatus) FROM orders""",
)
def distinct_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct values of attributes."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus")
    values = o.unpivot([], [col("o_orderpriority"), col("o_orderstatus")], "attribute", "value").distinct()
    return values.groupBy("attribute").agg(
        F.array_join(F.array_sort(F.collect_list("value")), ",").alias("groups"), F.count("value").alias("n_groups")
    )
