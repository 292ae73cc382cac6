"""Round trips through the supported formats, and the scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.catalog.fixtures import GAPPY_ORDERS, WEEKLY_EVENTS, gappy_orders, weekly_events
from riskloom.catalog.registry import query, rounded
from riskloom.functions import expr as E
from riskloom.session import shared_path
from riskloom.sources import batches
from riskloom.sources.tables import table

_ODD_WEEK = "2024-01-08"  # its file has other columns


@query(
    "csv_batches",
    f"""WITH {WEEKLY_EVENTS} SELECT week AS batch, CAST(event_id AS INT) AS event_id, CAST(user_id AS INT) AS user_id,
          CASE WHEN week = '2024-01-08' THEN NULL ELSE event_type END AS event_type, value
        FROM weekly""",
)
def csv_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All weekly CSV batches; the second lacks a column and has another one."""
    e = weekly_events(spark, sf_dir)
    weeks = [r["week"] for r in e.select("week").distinct().orderBy("week").collect()]  # a file each
    paths = {}
    for week in weeks:
        part = e.where(F.col("week") == week).drop("week")
        if week == _ODD_WEEK:
            part = part.select("value", F.lit("web").alias("channel"), "user_id", "event_id")
        paths[week] = shared_path(spark, f"csv-{week}")
        batches.write_csv(part, paths[week])
    return batches.read_batches(spark, paths)


@query(
    "json_table",
    f"WITH {GAPPY_ORDERS} SELECT o_orderkey, o_orderstatus, price, priority, level FROM gappy",
)
def json_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = gappy_orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "price", "priority", "level")
    path = shared_path(spark, "json")
    batches.write_json(o, path)
    return spark.read.schema(o.schema).json(path)


@query(
    "result_tables",
    f"""WITH {GAPPY_ORDERS} SELECT 'orders' AS name, count(*) AS n FROM gappy
        UNION ALL SELECT 'events', count(*) FROM events""",
)
def result_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named result tables written and read back; an absent optional one is left out."""
    root = shared_path(spark, "results")
    batches.write_results({"orders": gappy_orders(spark, sf_dir), "events": table(spark, sf_dir, "events")}, root)
    back = batches.read_results(spark, root, ["orders"], ["events", "absent"])
    out = None
    for name, df in back.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "scalar_expressions",
    """WITH x AS (SELECT *, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS d FROM lineitem)
       SELECT l_orderkey, l_linenumber,
         round(CASE WHEN l_tax > 0 THEN d / l_tax END, 6) AS guarded,
         CASE WHEN d > l_tax THEN 1 ELSE 0 END AS flagged,
         CASE WHEN l_quantity < 10 THEN 10 WHEN l_quantity > 40 THEN 40 ELSE l_quantity END AS limited,
         CASE WHEN d IS NULL THEN NULL WHEN d * 10 <= 0.33 THEN 'Low' WHEN d * 10 <= 0.67 THEN 'Medium' WHEN d * 10 <= 1 THEN 'High' END AS binned,
         CASE WHEN d IS NULL THEN 'N/A' WHEN d * 10 > 0.67 THEN 'High' WHEN d * 10 > 0.33 THEN 'Medium' ELSE 'Low' END AS graded,
         round(1 - (l_quantity - 1) / 49, 6) AS scaled,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE -1 END AS coded,
         printf('%.2f', l_tax) AS shown, substr(l_linestatus || l_returnflag, 1, 1) AS cut,
         CAST(trunc(l_extendedprice / 1000) AS INT) AS thousands,
         round(CASE WHEN l_tax >= l_discount THEN l_tax ELSE l_discount END, 6) AS largest_rate FROM x""",
)
def scalar_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    d = F.when(F.col("l_linenumber") != 3, F.col("l_discount"))
    rates = F.slice(F.array_sort(F.array(-F.col("l_tax"), -F.col("l_discount"))), 1, 1)
    return rounded(
        l.select(
            "l_orderkey",
            "l_linenumber",
            E.ratio(d, F.col("l_tax")).alias("guarded"),
            E.flag(d > F.col("l_tax")).alias("flagged"),
            E.clip(F.col("l_quantity"), 10.0, 40.0).alias("limited"),
            E.binned(d * 10, (0.0, 0.33, 0.67, 1.0), ("Low", "Medium", "High")).alias("binned"),
            E.graded(d * 10, ((0.67, "High"), (0.33, "Medium")), "Low", "N/A").alias("graded"),
            E.min_max(F.col("l_quantity"), 1, 50, invert=True).alias("scaled"),
            E.mapped(F.col("l_returnflag"), {"A": 1, "R": 2}, F.lit(-1)).alias("coded"),
            E.fixed(F.col("l_tax"), 2).alias("shown"),
            E.label_cut(F.concat("l_linestatus", "l_returnflag"), 1).alias("cut"),
            (F.col("l_extendedprice") / 1000).cast("int").alias("thousands"),
            (-rates[0]).alias("largest_rate"),
        )
    )
