"""Every registered query against its SQL counterpart, and the shape of its plan."""

import re

import pytest

from riskloom.catalog import ORACLES, QUERIES
from tests.oracle import difference


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, duck, ORACLES[name]) is None
    # no row products, and no Python in the plan
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|ArrowEvalPython|BatchEvalPython", plan_of(df))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(name, spark, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert rows
    assert len(set(df.columns)) == len(df.columns)


def test_difference_is_noticed(spark, sf_dir, duck):
    name = "class_weights"
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name].replace("5.0", "5.1")) is not None
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name] + " LIMIT 2") is not None


def test_scan_reads_only_what_it_needs(spark, sf_dir):
    plan = plan_of(QUERIES["outcome_distribution"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
