"""Streaming queries; each is compared with its batch counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.catalog.registry import query, rounded
from riskloom.functions.expr import col, pct
from riskloom.plans.rules import Check
from riskloom.session import shared_path
from riskloom.streaming import drift, intake


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.event_stream(spark, sf_dir, "events.parquet", "ts")


@query(
    "stream_weekly_panel",
    """SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, event_type, count(*) AS n,
         round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY date_trunc('week', ts)), 6) AS pct
       FROM events GROUP BY date_trunc('week', ts), event_type""",
)
def stream_weekly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    path = shared_path(spark, "weekly")
    intake.finished(intake.run_complete(intake.weekly_counts(_events(spark, sf_dir), "ts", "event_type"), path))
    total = F.sum("n").over(Window.partitionBy("week"))
    return rounded(intake.current(spark, path).withColumn("pct", pct(F.col("n"), total)))


@query(
    "stream_audit",
    """SELECT 'low_value' AS check_name, 'WARN' AS severity, count(*) AS affected_rows FROM events WHERE value < 1
       UNION ALL SELECT 'high_value', 'FAIL', count(*) FROM events WHERE value > 250""",
)
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        Check("low_value", "WARN", ("value",), col("value") < 1, "value < 1"),
        Check("high_value", "FAIL", ("value",), col("value") > 250, "value > 250"),
        Check("negative", "FAIL", ("value",), col("value") < 0, "value < 0"),
    ]
    path = shared_path(spark, "audit")
    intake.finished(intake.run_audit(_events(spark, sf_dir), checks, path))
    return spark.read.parquet(path).groupBy("check_name", "severity").agg(F.sum("affected_rows").alias("affected_rows"))


@query(
    "stream_pulse",
    """WITH w AS (SELECT date_trunc('day', ts) AS s, value FROM events
         UNION ALL SELECT date_trunc('day', ts) - INTERVAL 1 DAY, value FROM events)
       SELECT strftime(s, '%Y-%m-%d') AS start, count(*) AS n, round(avg(value), 6) AS score,
         CASE WHEN avg(value) < 49 THEN 1 ELSE 0 END AS alert FROM w GROUP BY s""",
)
def stream_pulse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "pulse")
    intake.finished(intake.run_complete(intake.pulse(_events(spark, sf_dir), "ts", "value", 49.0), path))
    return rounded(intake.current(spark, path))


@query("stream_without_repeats", "SELECT event_id, user_id, event_type, value FROM events")
def stream_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event arrives twice; the watermark covers the whole month, so none is late."""
    intake.on_disk_state(spark)
    e = _events(spark, sf_dir)
    twice = e.unionByName(_events(spark, sf_dir))
    path = shared_path(spark, "once")
    once = intake.without_repeats(twice, "ts", ["event_id"], "60 days")
    intake.finished(intake.run_append(once.select("event_id", "user_id", "event_type", "value"), path))
    return spark.read.parquet(path)


@query(
    "stream_cumulative_drift",
    """WITH d AS (SELECT date_trunc('week', ts) AS w, event_type, count(*) AS n FROM events GROUP BY ALL),
        closed AS (SELECT * FROM d WHERE w + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)),
        g AS (SELECT w.w, t.event_type, coalesce(n, 0) AS n FROM (SELECT DISTINCT w FROM closed) AS w
          CROSS JOIN (SELECT DISTINCT event_type FROM closed) AS t LEFT JOIN closed AS c ON c.w = w.w AND c.event_type = t.event_type),
        r AS (SELECT w, event_type, n, sum(n) OVER (PARTITION BY event_type ORDER BY w ROWS UNBOUNDED PRECEDING) - n AS before,
          sum(n) OVER (PARTITION BY w) AS total FROM g),
        s AS (SELECT *, sum(before) OVER (PARTITION BY w) AS total_before FROM r)
        SELECT strftime(w, '%Y-%m-%d') AS week, event_type, round(n * 100.0 / total, 6) AS this_pct,
          round(before * 100.0 / total_before, 6) AS cum_pct, round(n * 100.0 / total - before * 100.0 / total_before, 6) AS delta_pct
        FROM s WHERE total_before > 0 AND n + before > 0""",
)
def stream_cumulative_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed weeks against the running total, which is kept as state of the stream."""
    path = shared_path(spark, "drift")
    intake.finished(intake.run_append(drift.cumulative_drift(_events(spark, sf_dir), "ts", "event_type"), path))
    return rounded(spark.read.parquet(path))
