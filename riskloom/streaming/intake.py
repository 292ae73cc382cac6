"""Intake checks on a stream.

Event time must be a zoned ``timestamp`` for a watermark, so sources with local
timestamps are cast first.  A result that must equal its batch counterpart runs
in complete mode; in append mode rows later than the watermark are dropped.
Duplicate removal holds a key per event for as long as the watermark, so it runs on
the RocksDB state store (``on_disk_state``), which need not fit into memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.expr import col
from riskloom.operators.quality import integrity_audit
from riskloom.plans.rules import Check

# seven-day windows that begin on Mondays; the epoch was a Thursday
WEEK, MONDAY = "7 days", "4 days"


def event_stream(spark: SparkSession, folder: str, pattern: str, time: str, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream, with the time column made zoned."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )
    return stream.withColumn(time, col(time).cast("timestamp"))


def weekly_counts(stream: DataFrame, time: str, target: str, lateness: str = "1 day") -> DataFrame:
    """(week, target, n) per seven-day window."""
    return (
        stream.withWatermark(time, lateness)
        .groupBy(F.window(col(time), WEEK, startTime=MONDAY).alias("w"), col(target))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("week"), col(target), "n")
    )


def pulse(
    stream: DataFrame, time: str, value: str, floor: float, width: str = "2 days", slide: str = "1 day", lateness: str = "1 day"
) -> DataFrame:
    """(start, n, score, alert): mean per sliding window, alert below ``floor``."""
    return (
        stream.withWatermark(time, lateness)
        .groupBy(F.window(col(time), width, slide).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(col(value)).alias("score"))
        .select(
            F.date_format("w.start", "yyyy-MM-dd").alias("start"),
            "n",
            "score",
            F.coalesce((F.col("score") < floor).cast("int"), F.lit(0)).alias("alert"),
        )
    )


def without_repeats(stream: DataFrame, time: str, keys: Sequence[str], lateness: str) -> DataFrame:
    """First row per key within the watermark."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def checkpoint_of(path: str) -> str:
    """The checkpoint folder of a sink.

    It lies beside the sink and is named after it, so whoever writes to the sink again goes on where the last run
    ended.  Deleting one of the two without the other loses or repeats rows.
    """
    return path.rstrip("/") + "-checkpoint"


def on_disk_state(spark: SparkSession) -> None:
    """Let streams that start from now on keep their state in RocksDB."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def run_complete(result: DataFrame, path: str) -> StreamingQuery:
    """Write the whole current result below ``path`` at every trigger; ``current`` reads the last one.

    Each trigger has a folder of its own, so a reader always finds a whole result.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        result.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint_of(path))
        .trigger(availableNow=True)
        .foreachBatch(replace)
        .start()
    )


def current(spark: SparkSession, path: str) -> DataFrame:
    """The last whole result that ``run_complete`` has written."""
    every = spark.read.parquet(path)
    last = every.agg(F.max("batch_id")).first()[0]
    return every.where(F.col("batch_id") == last).drop("batch_id")


def run_append(result: DataFrame, path: str) -> StreamingQuery:
    """Append finished rows to Parquet files, exactly once, over restarts, too."""
    return (
        result.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint_of(path))
        .trigger(availableNow=True)
        .start()
    )


def run_audit(stream: DataFrame, checks: Sequence[Check], path: str) -> StreamingQuery:
    """Audit every micro-batch and write its findings under its batch number.

    The number goes on after a restart.  A batch that is run again after a failure replaces its own findings.
    """

    def audit(batch: DataFrame, batch_id: int) -> None:
        integrity_audit(batch, checks).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.option("checkpointLocation", checkpoint_of(path))
        .trigger(availableNow=True)
        .foreachBatch(audit)
        .start()
    )


def finished(query: StreamingQuery) -> None:
    """Wait until all available files are processed; an error in the stream is raised here."""
    query.awaitTermination()
