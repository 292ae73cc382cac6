"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
EVEN = 8 << 20  # bytes of a row group of tables that are read many times


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", folder: str | None = None
) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own.

    ``folder`` is the folder of staged tables.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` names it.

    Without that setting only a local master is served, whose one machine sees the folder below Spark's own working
    folder; on a cluster no folder of one machine would do, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(os.path.abspath("spark-staging"), spark.sparkContext.applicationId)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), "riskloom", f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str = "stage", group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage before several passes over the same derived table.  Unlike
    an executor-local cache it survives lost executors, and later passes still
    prune columns and push filters.  A row group goes to one task, so few files
    of large groups leave cores idle; ``group_bytes`` is then their size.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    writer = df.write.option("parquet.block.size", str(group_bytes)) if group_bytes else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, works: Sequence[Callable[[], T]], at_once: int | None = None) -> list[T]:
    """The results of ``works``, whose jobs run at the same time, up to ``at_once`` of them.

    Jobs of few tasks, one behind the other, leave most cores idle; those of several works fill them.
    """
    if not works:
        return []
    with ThreadPoolExecutor(max(1, min(len(works), at_once or len(works)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(w)) for w in works]]
