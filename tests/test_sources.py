"""Batches, result tables, records and staging."""

import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from riskloom import session
from riskloom.functions.expr import col
from riskloom.sources import batches


def _csv(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_first_batch_fixes_the_schema(spark, tmp_path):
    one = _csv(tmp_path, "w1.csv", " id , score,name\n1,2.5,a\n2,,b\n")
    two = _csv(tmp_path, "w2.csv", "name,extra,id\nc,9,3\n,9,x\n")
    df = batches.read_batches(spark, {1: one, 2: two})
    assert df.dtypes == [("batch", "int"), ("id", "int"), ("score", "double"), ("name", "string")]
    rows = sorted(map(tuple, df.collect()), key=str)
    assert rows == sorted([(1, 1, 2.5, "a"), (1, 2, None, "b"), (2, 3, None, "c"), (2, None, None, None)], key=str)


def test_given_schema(spark, tmp_path):
    path = _csv(tmp_path, "w.csv", "x,y\n1.0,oops\n1.5,2\n")
    want = T.StructType([T.StructField("y", T.DoubleType()), T.StructField("x", T.LongType())])
    assert [tuple(r) for r in batches.read_csv_batch(spark, path, want).collect()] == [(None, 1), (2.0, None)]


def test_missing_batch_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        batches.read_batches(spark, {1: str(tmp_path / "none.csv")})


def test_nan_is_missing_in_records(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (2, 0.5, "x")], "id int, v double, t string")
    got = [json.loads(r["record"]) for r in batches.json_records(df).orderBy("record").collect()]
    assert got == [{"id": 1, "v": None, "t": None}, {"id": 2, "v": 0.5, "t": "x"}]
    assert batches.json_records(df.where("id > 9")).collect() == []


def test_tables_keep_types(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b", None)], "`Mother's job (code)` int, t string, d double")
    batches.write_results({"one": df, "two": df}, str(tmp_path))
    back = batches.read_results(spark, str(tmp_path), ["one"], ["two", "three"])
    assert set(back) == {"one", "two"}
    assert back["one"].schema == df.schema and back["one"].collect() == df.collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        batches.read_results(spark, str(tmp_path), ["four"])
    batches.write_json(df, str(tmp_path / "j"))
    assert json.loads(spark.read.text(str(tmp_path / "j")).first()[0]) == {"Mother's job (code)": 1, "t": "a b", "d": None}
    batches.write_csv(df, str(tmp_path / "c"))
    assert batches.read_csv_batch(spark, str(tmp_path / "c"), df.schema).collect() == df.collect()


def test_stage_cuts_the_lineage(spark):
    df = spark.range(10).withColumn("x (y)", F.rand(1))
    staged = session.stage(df)
    assert staged.schema.names == df.schema.names
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "parquet" in plan.lower()
    assert sorted(r[0] for r in staged.select(col("x (y)")).collect()) == sorted(r[0] for r in df.select(col("x (y)")).collect())


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.shared_dir(spark) == named
        assert session.shared_path(spark, "a").startswith(named)
    assert session.shared_path(spark, "a") != session.shared_path(spark, "a")
