"""Exact order statistics on both of their ways, against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluate, orderstats
from riskloom.operators.orderstats import (
    column_facts,
    exact_quantiles,
    few_distinct,
    global_rank,
    modes,
    select_ranks,
    value_counts,
)
from riskloom.operators.split import stratified_folds, stratified_split

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def _values():
    rng = np.random.default_rng(5)
    heavy = np.exp(rng.normal(0, 6, 3000))  # many orders of magnitude
    hot = np.where(rng.random(3000) < 0.4, 7.0, rng.normal(0, 1, 3000))  # one value holds 40 %
    return {"heavy": heavy, "hot": hot, "flat": np.full(3000, 2.5), "signed": rng.normal(0, 1e-9, 3000)}


@pytest.fixture(scope="module")
def table(spark):
    v = _values()
    rows = [(i, "ab"[i % 3 == 0], *(float(v[c][i]) for c in v)) for i in range(3000)]
    return spark.createDataFrame(rows, ["id", "g", *v]).repartition(7)


@pytest.mark.parametrize("limit", [10**9, 0])
def test_quantiles(table, limit):
    got = {r["column"]: r["q"] for r in exact_quantiles(table, list(_values()), PROBS, map_limit=limit).collect()}
    for c, v in _values().items():
        assert got[c] == pytest.approx(list(np.quantile(v, PROBS)), rel=1e-12)


@pytest.mark.parametrize("limit", [10**9, 0])
def test_grouped_quantiles(table, limit):
    got = {(r["g"], r["column"]): (r["n"], r["q"]) for r in exact_quantiles(table, ["heavy", "hot"], PROBS, ["g"], limit).collect()}
    v = _values()
    for g, pick in (("b", [i for i in range(3000) if i % 3 == 0]), ("a", [i for i in range(3000) if i % 3])):
        for c in ("heavy", "hot"):
            n, q = got[g, c]
            assert n == len(pick)
            assert q == pytest.approx(list(np.quantile(v[c][pick], PROBS)), rel=1e-12)


def test_infinite_values_end(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, math.inf, -math.inf)], ["x"])
    long = df.select(F.lit("x").alias("column"), F.col("x").alias("value"))
    found = select_ranks(long, ["column"], lambda _, n: range(n))
    assert found[("x",)] == (5, {0: -math.inf, 1: 1.0, 2: 2.0, 3: 3.0, 4: math.inf})


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, x double")
    for limit in (0, 100):
        got = {r["g"]: r["q"][0] for r in exact_quantiles(df, ["x"], [0.5], ["g"], limit).collect()}
        assert got == {None: 2.0, "a": 5.0}


def test_column_without_values_has_no_row(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert [r["column"] for r in exact_quantiles(df, ["x", "y"], [0.5]).collect()] == ["y"]
    assert [r["column"] for r in exact_quantiles(df, ["x", "y"], [0.5], map_limit=0).collect()] == ["y"]


def test_even_median_and_mode_tie(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 3), (3.0, 1), (10.0, 1), (None, 2)], "x double, m int")
    assert exact_quantiles(df, ["x"], [0.5]).first()["q"] == [2.5]
    assert modes(df, ["m"]) == {"m": 1.0}


def test_few_distinct(spark):
    df = spark.range(1000).select((F.col("id") % 25).alias("a"), (F.col("id") % 26).alias("b"), F.col("id").alias("c"))
    assert few_distinct(df, ["a", "b", "c"], 25) == {"a": 25, "b": None, "c": None}
    assert column_facts(df, ["a"]).known("a") == 1000


def test_value_counts_collapse_hot_values(table):
    assert value_counts(table, ["flat"]).collect()[0]["n"] == 3000


@pytest.mark.parametrize("per_task", [10**9, 250])
def test_global_rank(table, per_task):
    got = global_rank(table, [("hot", True), ("id", False)], "r", per_task).select("id", "r").collect()
    v = _values()["hot"]
    want = sorted(range(3000), key=lambda i: (-v[i], i))
    assert {r["id"]: r["r"] for r in got} == {i: k + 1 for k, i in enumerate(want)}


@pytest.mark.parametrize("per_task", [10**9, 1])
def test_split_and_folds_are_exact(table, per_task):
    split = stratified_split(table, "g", "id", 0.2, rows_per_task=per_task)
    sizes = {(r["g"], r["split"]): r["count"] for r in split.groupBy("g", "split").count().collect()}
    assert sizes == {("b", "test"): 200, ("b", "train"): 800, ("a", "test"): 400, ("a", "train"): 1600}
    folds = stratified_folds(table, "g", "id", 7, rows_per_task=per_task)
    per = folds.groupBy("g", "fold").count().collect()
    assert sorted(r["count"] for r in per if r["g"] == "b") == [142, 143, 143, 143, 143, 143, 143]
    assert {r["fold"] for r in per} == set(range(1, 8))


def test_split_is_the_same_on_both_ways_and_any_partitioning(table):
    def test_ids(df, per_task):
        s = stratified_split(df, "g", "id", 0.2, rows_per_task=per_task)
        return sorted(r["id"] for r in s.where("split = 'test'").select("id").collect())

    assert test_ids(table, 10**9) == test_ids(table.repartition(3), 1) == test_ids(table.coalesce(1), 1500)


def _auc(y, s):
    pos, neg = s[y], s[~y]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_task", [10**9, 20])
def test_auc_with_ties(spark, per_task):
    rng = np.random.default_rng(3)
    truth = rng.choice(["x", "y", "z"], 400)
    score = {k: np.round(rng.random(400) + (truth == k) * 0.3, 2) for k in "xyz"}
    rows = [(str(truth[i]), *(float(score[k][i]) for k in "xyz")) for i in range(400)]
    df = spark.createDataFrame(rows, ["t", "p_x", "p_y", "p_z"])
    got = {r["label"]: r["auc"] for r in evaluate.roc_auc_ovr(df, "t", {k: f"p_{k}" for k in "xyz"}, rows_per_task=per_task).collect()}
    want = {k: _auc(truth == k, score[k]) for k in "xyz"}
    assert got == pytest.approx({**want, "macro": sum(want.values()) / 3})


def test_auc_edges(spark):
    same = spark.createDataFrame([("a", 0.5, 0.5), ("b", 0.5, 0.5)], ["t", "p_a", "p_b"])
    got = {r["label"]: r["auc"] for r in evaluate.roc_auc_ovr(same, "t", {"a": "p_a", "b": "p_b"}).collect()}
    assert got == {"a": 0.5, "b": 0.5, "macro": 0.5}
    one = spark.createDataFrame([("a", 0.5, 0.5)], ["t", "p_a", "p_b"])
    got = {r["label"]: r["auc"] for r in evaluate.roc_auc_ovr(one, "t", {"a": "p_a", "b": "p_b"}).collect()}
    assert got == {"a": None, "b": None, "macro": 0.0}


def test_values_over_many_decades_take_few_rounds(spark, monkeypatch):
    df = spark.range(4000).select((F.pow(F.lit(10.0), F.col("id") / 8.0 - 250) * F.when(F.col("id") % 2 == 0, 1).otherwise(-1)).alias("x"))
    want = sorted(r["x"] for r in df.collect())
    rounds = []
    plain = orderstats._Bracket

    def counted(*args):
        rounds.append(args)
        return plain(*args)

    monkeypatch.setattr(orderstats, "_Bracket", counted)
    got = orderstats.select_ranks(orderstats.long_values(df, ["x"]), ["column"], lambda _, n: [0, 1000, 1999, 2000, 3999])
    assert got[("x",)][1] == {i: want[i] for i in (0, 1000, 1999, 2000, 3999)}
    assert len(rounds) <= 5 * 9


def test_infinite_values_have_ranks(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,), (2.0,), (3.0,), (-5.0,)], "x double")
    got = orderstats.select_ranks(orderstats.long_values(df, ["x"]), ["column"], lambda _, n: range(n))
    assert [got[("x",)][1][i] for i in range(6)] == [float("-inf"), -5.0, 1.0, 2.0, 3.0, float("inf")]


def test_many_groups_with_one_that_holds_a_third(spark):
    df = spark.range(60_000).select(F.when(F.col("id") < 20_000, 0).otherwise(F.col("id") % 20_000 + 1).alias("g"), F.col("id").cast("double").alias("x"))
    got = orderstats.exact_quantiles(df, ["x"], [0.5], ["g"], map_limit=1000)
    rows = {r["g"]: r["q"][0] for r in got.collect()}
    assert len(rows) == 20_001
    assert rows[0] == 9999.5 and rows[1] == 30_000.0
