"""Reading batches, writing tables, models and JSON records."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.functions.expr import col
from riskloom.operators.schema import clean_names, coerce_to_schema, nan_to_null, stack_batches


def read_csv_batch(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One CSV batch with header.

    With a schema the text is read as strings and matched by header name, so
    column order, extra columns and bad values do not matter.  Without one the
    types are inferred, which the first batch needs.  A missing file raises.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return nan_to_null(clean_names(reader.option("inferSchema", True).csv(path)))
    return coerce_to_schema(clean_names(reader.csv(path)), schema)


def read_batches(
    spark: SparkSession,
    paths: Mapping[str | int, str],
    schema: T.StructType | None = None,
    batch: str = "batch",
    keep: Sequence[str] = (),
) -> DataFrame:
    """All batches as one table with a batch label; the first batch fixes the schema."""
    labels = list(paths)
    parts = {}
    for label in labels:
        if schema is None:
            parts[label] = read_csv_batch(spark, paths[label])
            schema = parts[label].schema
        else:
            parts[label] = read_csv_batch(spark, paths[label], schema)
    return stack_batches(parts, batch)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def json_records(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row in ``record``; missing values are written as null."""
    clean = nan_to_null(df)
    record = F.to_json(F.struct(*[col(c) for c in clean.columns]), {"ignoreNullFields": "false"})
    return clean.select(*[col(c) for c in keep], record.alias("record"))


def read_results(spark: SparkSession, root: str, required: Sequence[str], optional: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Result tables below ``root``; an optional one may be absent, a required one raises."""
    out = {name: spark.read.parquet(os.path.join(root, name)) for name in required}
    for name in optional:
        try:
            out[name] = spark.read.parquet(os.path.join(root, name))
        except Exception as e:  # the reader reports a missing path as an analysis error
            if "PATH_NOT_FOUND" not in str(e):
                raise
    return out


def write_results(results: Mapping[str, DataFrame], root: str) -> None:
    for name, df in results.items():
        write_table(df, os.path.join(root, name))
