"""Streams over several files, in append and complete mode."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions.expr import col
from riskloom.plans.rules import Check
from riskloom.streaming import intake


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Twenty-eight days of one event per hour, one file per week, written in time order."""
    path = str(tmp_path_factory.mktemp("events"))
    rows = spark.range(28 * 24).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("kind"),
        (F.col("id") % 50).cast("double").alias("value"),
    )
    for week in range(4):
        rows.where(F.floor(F.col("event_id") / 168) == week).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, folder):
    return intake.event_stream(spark, folder, "*.parquet", "ts", files_per_trigger=1)


def test_complete_mode_equals_batch(spark, folder, tmp_path):
    out = str(tmp_path / "weekly")
    intake.finished(intake.run_complete(intake.weekly_counts(stream(spark, folder), "ts", "kind"), out))
    got = {(r["week"], r["kind"]): r["n"] for r in intake.current(spark, out).collect()}
    assert got == {(w, k): n for w in ("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22") for k, n in (("x", 56), ("y", 112))}


def test_append_mode_leaves_the_open_window_out(spark, folder, tmp_path):
    out = str(tmp_path / "closed")
    intake.finished(intake.run_append(intake.weekly_counts(stream(spark, folder), "ts", "kind"), out))
    got = {(r["week"], r["kind"]): r["n"] for r in spark.read.parquet(out).collect()}
    assert got == {(w, k): n for w in ("2024-01-01", "2024-01-08", "2024-01-15") for k, n in (("x", 56), ("y", 112))}


def test_audit_per_micro_batch(spark, folder, tmp_path):
    out = str(tmp_path / "audit")
    checks = [Check("high", "WARN", ("value",), col("value") > 40, "value > 40")]
    intake.finished(intake.run_audit(stream(spark, folder), checks, out))
    rows = spark.read.parquet(out).collect()
    assert len({r["batch_id"] for r in rows}) == 4
    assert sum(r["affected_rows"] for r in rows) == sum(1 for i in range(672) if i % 50 > 40)


def test_repeats_within_the_watermark_go(spark, folder, tmp_path):
    out = str(tmp_path / "once")
    twice = stream(spark, folder).unionByName(stream(spark, folder))
    intake.finished(intake.run_append(intake.without_repeats(twice, "ts", ["event_id"], "60 days"), out))
    assert spark.read.parquet(out).count() == 672


def test_pulse_alerts(spark, folder, tmp_path):
    out = str(tmp_path / "pulse")
    intake.finished(intake.run_complete(intake.pulse(stream(spark, folder), "ts", "value", 24.0), out))
    for r in intake.current(spark, out).collect():
        assert r["alert"] == int(r["score"] < 24.0)


def test_a_failing_stream_raises(spark, folder, tmp_path):
    bad = [Check("boom", "WARN", ("value",), F.raise_error(F.lit("boom")).cast("boolean"), "")]
    with pytest.raises(Exception, match="boom"):
        intake.finished(intake.run_audit(stream(spark, folder), bad, str(tmp_path / "bad")))


@pytest.fixture
def growing(spark, tmp_path):
    """A folder with ten events, and a function that adds three more."""
    path = str(tmp_path / "growing")

    def add(first, n):
        spark.range(first, first + n).select(
            F.col("id").alias("event_id"),
            (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz").alias("ts"),
            F.lit("x").alias("kind"),
            F.col("id").cast("double").alias("value"),
        ).coalesce(1).write.mode("append").parquet(path)

    add(0, 10)
    return path, lambda: add(10, 3)


def test_append_goes_on_after_a_restart(spark, growing, tmp_path):
    folder, add = growing
    out = str(tmp_path / "rows")
    for _ in range(2):
        once = intake.without_repeats(stream(spark, folder), "ts", ["event_id"], "60 days")
        intake.finished(intake.run_append(once, out))
        add()
    intake.finished(intake.run_append(intake.without_repeats(stream(spark, folder), "ts", ["event_id"], "60 days"), out))
    ids = sorted(r["event_id"] for r in spark.read.parquet(out).collect())
    assert ids == list(range(13))  # the second addition repeats the first one's keys


def test_audit_goes_on_after_a_restart(spark, growing, tmp_path):
    folder, add = growing
    out = str(tmp_path / "findings")
    checks = [Check("all", "WARN", ("value",), col("value") >= 0, "")]
    intake.finished(intake.run_audit(stream(spark, folder), checks, out))
    add()
    intake.finished(intake.run_audit(stream(spark, folder), checks, out))
    rows = spark.read.parquet(out).collect()
    assert sorted(r["affected_rows"] for r in rows) == [3, 10]


def test_complete_goes_on_after_a_restart(spark, growing, tmp_path):
    folder, add = growing
    out = str(tmp_path / "counts")
    for n in (10, 13):
        intake.finished(intake.run_complete(intake.weekly_counts(stream(spark, folder), "ts", "kind"), out))
        assert [r["n"] for r in intake.current(spark, out).collect()] == [n]
        add()


def test_running_drift_equals_the_batch_result_over_restarts(spark, tmp_path):
    from riskloom.operators.drift import drift_vs_cumulative
    from riskloom.streaming.drift import cumulative_drift

    path, out = str(tmp_path / "weeks"), str(tmp_path / "drift")
    # week 2 lacks an outcome, week 4 brings a new one, some outcomes are unknown
    kind = "CASE WHEN id % 7 = 0 THEN NULL WHEN week = 4 AND id % 5 = 0 THEN 'new' WHEN week <> 2 AND id % 3 = 0 THEN 'x' ELSE 'y' END"
    rows = spark.range(6 * 168).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz").alias("ts"),
        F.expr(kind.replace("week", "(id div 168 + 1)")).alias("kind"),
        (F.col("id") / 168).cast("int").alias("no"),
    )
    rows.where("no < 3").coalesce(1).write.parquet(path)
    for first, last in ((3, 4), (5, 5)):
        q = intake.run_append(cumulative_drift(stream(spark, path), "ts", "kind"), out)
        intake.finished(q)
        rows.where(F.col("no").between(first, last)).coalesce(1).write.mode("append").parquet(path)
    intake.finished(intake.run_append(cumulative_drift(stream(spark, path), "ts", "kind"), out))
    got = {(r["week"], r["kind"]): (r["this_pct"], r["cum_pct"], r["delta_pct"]) for r in spark.read.parquet(out).collect()}
    batches = rows.withColumn("week", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd"))
    want = {
        (r["week"], r["kind"]): (r["this_pct"], r["cum_pct"], r["delta_pct"])
        for r in drift_vs_cumulative(batches, "week", "kind").collect()
    }
    closed = {k: v for k, v in want.items() if k[0] < "2024-02-05"}  # the last week is open
    assert got.keys() == closed.keys() and ("2024-01-22", "new") in got
    for k in closed:
        assert got[k] == pytest.approx(closed[k])
