"""Schemas, column kinds and alignment of batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.functions.expr import col, no_nan, number, whole_number
from riskloom.operators.orderstats import few_distinct
from riskloom.plans.rules import BINARY, CODE, CONTINUOUS, KINDS, TEXT, RuleSet

CODE_LIMIT = 20
INDICATOR_SUFFIXES = ("__is_missing", "__is_outlier")


def infer_schema(df: DataFrame) -> dict[str, str]:
    """column -> type name, in the order of the columns, as the first batch defines it."""
    return dict(df.dtypes)


def contract_schema(contract: Mapping[str, str]) -> T.StructType:
    """The schema that a column -> type name contract stands for."""
    return T.StructType([T.StructField(c, T.DataType.fromDDL(t)) for c, t in contract.items()])


def contract_rows(spark: SparkSession, contract: Mapping[str, str]) -> DataFrame:
    """(position, column, type): a contract as a table, to be kept beside the batches."""
    rows = [(i, c, t) for i, (c, t) in enumerate(contract.items(), 1)]
    return spark.createDataFrame(rows, "position int, column string, type string")


def read_contract(table: DataFrame) -> dict[str, str]:
    """The contract that ``contract_rows`` made the table from; a row per column."""
    return {r["column"]: r["type"] for r in table.orderBy("position").collect()}


def batches_by_contract(
    batches: Mapping[str | int, DataFrame], contract: Mapping[str, str] | None = None, batch: str = "batch"
) -> DataFrame:
    """All batches under one contract, by default that of the first batch, with the label as first column."""
    names = list(batches)
    schema = contract_schema(contract or infer_schema(batches[names[0]]))
    return stack_batches({n: coerce_to_schema(batches[n], schema) for n in names}, batch)


def is_number(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType)


def numeric_columns(
    df: DataFrame, exclude: Sequence[str] = (), indicators: bool = True
) -> list[str]:
    """Numeric columns, without the named ones and, if asked, without 0/1 indicators."""
    return [
        f.name
        for f in df.schema
        if is_number(f.dataType)
        and f.name not in exclude
        and (indicators or not f.name.endswith(INDICATOR_SUFFIXES))
    ]


def clean_names(df: DataFrame) -> DataFrame:
    """Strip blanks around header names."""
    return df.toDF(*[c.strip() for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            no_nan(col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else col(f.name)
            for f in df.schema
        ]
    )


def _coerced(source: Column, target: T.DataType) -> Column:
    if isinstance(target, T.IntegralType):
        return whole_number(source).try_cast(target)
    if isinstance(target, (T.DoubleType, T.FloatType)):
        return number(source).cast(target)
    if isinstance(target, T.StringType):
        return source.cast("string")  # missing stays missing
    return source.try_cast(target)


def coerce_to_schema(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Give ``df`` exactly the columns of ``schema``.

    Missing columns appear as NULL, extra ones go, values that do not fit the
    type become NULL.  Columns in ``keep`` are passed on as they are.
    """
    out = []
    for f in schema:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name in keep or df.schema[f.name].dataType == f.dataType:
            out.append(col(f.name))
        else:
            out.append(_coerced(col(f.name), f.dataType).alias(f.name))
    return df.select(*out)


def schema_difference(df: DataFrame, schema: T.StructType) -> dict[str, list[str]]:
    """Columns missing from, and extra to, the schema of the first batch."""
    have, want = set(df.columns), set(schema.names)
    return {"missing": sorted(want - have), "extra": sorted(have - want)}


def stack_batches(batches: Mapping[str | int, DataFrame], batch: str = "batch") -> DataFrame:
    """One table of all batches, with the batch label as first column."""
    out = None
    for label, df in batches.items():
        part = df.select(F.lit(label).alias(batch), *[col(c) for c in df.columns])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def dtype_summary(df: DataFrame) -> DataFrame:
    """Per type: number of columns, their names, and how many known cells they hold."""
    known = df.agg(*[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("dtype"), F.lit(c).alias("column"), F.col(f"c{i}").alias("n"))
            for i, (c, t) in enumerate(df.dtypes)
        ]
    )
    return (
        known.select(F.inline(rows))
        .groupBy("dtype")
        .agg(
            F.count(F.lit(1)).alias("n_cols"),
            F.array_join(F.array_sort(F.collect_list("column")), ",").alias("columns"),
            F.sum("n").alias("known_cells"),
        )
        .orderBy(F.desc("n_cols"), "dtype")
    )


def classify_columns(df: DataFrame, rules: RuleSet | None = None, exclude: Sequence[str] = ()) -> dict[str, str]:
    """column -> kind: rules first, else decided by the values.

    Text is ``categorical_text``; at most two values within {0, 1} is
    ``binary``; whole numbers with at most 20 values are ``categorical_code``;
    other numbers are ``continuous``.
    """
    rules = rules or RuleSet()
    kinds: dict[str, str] = {}
    unknown = []
    for f in df.schema:
        if f.name in exclude:
            continue
        if f.name in rules.kinds:
            kinds[f.name] = rules.kinds[f.name]
        elif not is_number(f.dataType):
            kinds[f.name] = TEXT
        else:
            kinds[f.name] = CONTINUOUS
            unknown.append(f)
    if unknown:
        names = [f.name for f in unknown]
        distinct = few_distinct(df, names, CODE_LIMIT)
        odd = df.agg(
            *[
                F.count_if(~number(col(c)).isin(0.0, 1.0)).alias(f"o{i}")
                for i, c in enumerate(names)
            ]
        ).first()
        for i, f in enumerate(unknown):
            n = distinct[f.name]
            if n == 0:
                kinds[f.name] = TEXT
            elif n is not None and n <= 2 and odd[f"o{i}"] == 0:
                kinds[f.name] = BINARY
            elif n is not None and isinstance(f.dataType, T.IntegralType):
                kinds[f.name] = CODE
    return {c: kinds[c] for c in df.columns if c in kinds}


def column_types(df: DataFrame, rules: RuleSet | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """(column, var_type), one row per column."""
    kinds = classify_columns(df, rules, exclude)
    return df.sparkSession.createDataFrame(list(kinds.items()), "column string, var_type string")


def group_by_kind(kinds: Mapping[str, str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {k: [] for k in KINDS}
    for c, k in kinds.items():
        out[k].append(c)
    return out
