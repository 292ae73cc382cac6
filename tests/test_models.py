"""Fitted models: repeatable, better than guessing, and measured right."""

import math
import os
import threading
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.catalog import evaluation
from riskloom.catalog.modeling import POSITIVE, fitted
from riskloom.operators import boosting, forest, models, sparse_logistic
from riskloom.operators.trees import LEAF, joined
from riskloom.operators.models import Settings, cross_validate, fit_preparation, load_trained, train
from riskloom.plans import student
from riskloom.operators.scenarios import Scenario
from riskloom.plans.actions import ActionPlan
from tests.oracle import DATA

MODELS = ["Logistic_L1", "Decision_Tree", "Random_Forest", "Boosted_Trees"]


@pytest.fixture(scope="module")
def run(spark):
    return fitted(spark, os.path.join(DATA, "sf0.01"))


def test_full_configuration_is_the_default():
    s = Settings()
    assert (s.forest_trees, s.forest_depth, s.forest_leaf) == (200, 10, 30)
    assert (s.boost_rounds, s.boost_depth, s.boost_rate, s.boost_leaf) == (300, 6, 0.05, 5)
    assert (s.tree_depth, s.tree_leaf, s.penalty) == (5, 50, 0.1)
    assert (s.boost_gain, s.boost_l1, s.boost_l2) == (0.1, 0.1, 1.0)


def test_split_keeps_the_class_shares(run):
    got = {(r[0], r[1]): r[2] for r in run.rows.groupBy("Target", "split").count().collect()}
    for k in student.CLASSES:
        n = got[k, "test"] + got[k, "train"]
        assert got[k, "test"] == int(0.2 * n + 0.5)


def test_models_beat_the_majority_class(run):
    share = run.test.groupBy("Target").count().agg(F.max("count") / F.sum("count")).first()[0]
    accuracy = {r["model"]: r["f1"] for r in run.reports().where("label = 'accuracy'").collect()}
    auc = {r["model"]: r["auc"] for r in run.comparison().collect()}
    # guessing has an AUC of 0.5; a linear model cannot follow the middle band that is the outcome
    for m, a in auc.items():
        assert a > (0.6 if m == "Logistic_L1" else 0.85), (m, a)
        assert accuracy[m] > share, (m, accuracy[m], share)


def test_probabilities_add_up(run):
    total = sum((F.col(p) for p in run.probabilities.values()), F.lit(0.0))
    worst = run.scored.select(F.max(F.abs(total - 1))).first()[0]
    assert worst < 1e-9


def test_metrics_again_by_sql(run):
    pdf = run.scored.withColumnRenamed("Target", "truth").toPandas()
    con = duckdb.connect()
    con.register("scored", pdf)
    rows = con.execute(
        f"WITH {evaluation.report_sql('model')} SELECT model, CAST(f1 AS DOUBLE) FROM report WHERE label = 'macro avg'"
    ).fetchall()
    got = {r["model"]: r["f1"] for r in run.comparison().collect()}
    assert got == pytest.approx(dict(rows))
    for m, a in {r["model"]: r["auc"] for r in run.comparison().collect()}.items():
        pairs = con.execute(
            "SELECT avg(a) FROM ("
            + " UNION ALL ".join(
                f"SELECT avg(CASE WHEN p.p_{k} > n.p_{k} THEN 1 WHEN p.p_{k} = n.p_{k} THEN 0.5 ELSE 0 END) AS a FROM scored p, scored n "
                f"WHERE p.model = '{m}' AND n.model = '{m}' AND p.truth = '{k}' AND n.truth <> '{k}'"
                for k in run.trained.classes
            )
            + ")"
        ).fetchone()[0]
        assert a == pytest.approx(pairs)


def test_confusions_hold_every_test_row(run):
    n = run.test.count()
    rows = run.confusions().collect()
    for m in run.trained.models:
        assert sum(r[f"pred_{k}"] for r in rows if r["model"] == m for k in run.trained.classes) == n


def test_same_seed_same_model(spark, run):
    rows = run.rows.where("split = 'train'")
    names = ["Admission grade", "CR_Sem1", "CR_Sem2", "Debtor"]
    one, two = (train(rows, "Target", names, settings=Settings(), names=["Decision_Tree", "Random_Forest"]) for _ in range(2))
    for m in ("Decision_Tree", "Random_Forest"):
        a, b = (t.score(run.test, m, ["student_id"]).orderBy("student_id").collect() for t in (one, two))
        assert a == b


def test_saved_models_score_alike(spark, run, tmp_path):
    path = str(tmp_path / "models")
    run.trained.save(path)
    back = load_trained(path, list(run.trained.models), run.trained.numeric, run.trained.categorical, run.trained.classes)
    for m in run.trained.models:
        a, b = (t.score(run.test, m, ["student_id"]).orderBy("student_id").collect() for t in (run.trained, back))
        assert a == b


def test_preparation_learns_from_training_rows_only(spark):
    tr = spark.createDataFrame([(1.0, "b"), (3.0, "a"), (None, None)], "`x (1)` double, t string")
    te = spark.createDataFrame([(None, "c"), (100.0, "a")], "`x (1)` double, t string")
    rows = fit_preparation(tr, ["x (1)"], ["t"]).transform(te).select("_features").collect()
    assert [list(r[0]) for r in rows] == [[2.0, 2.0], [100.0, 0.0]]


@pytest.mark.parametrize("model", MODELS)
def test_contributions_add_up_to_the_output(run, model):
    """On rows with gaps and with text features: their sum is the model's output less its mean on the training rows."""
    assert len(run.trained.categorical) == 2
    plan = ActionPlan.of(run, model, POSITIVE)
    sums = plan.explained(plan.rows).select(
        "student_id", F.aggregate("contributions", F.lit(0.0), lambda a, s: a + s["contribution"]).alias("s")
    )
    rows = run.trained.with_output(run.test, model, POSITIVE, "m").select("student_id", "m").join(sums, "student_id").collect()
    assert len(rows) == run.test.count()
    base = run.trained.base(model, POSITIVE)
    for r in rows:
        assert r["s"] == pytest.approx(r["m"] - base, abs=1e-9)
    if model == "Boosted_Trees":  # the base is the mean margin of the training rows
        train_rows = run.trained.with_output(run.rows.where("split = 'train'"), model, POSITIVE, "m")
        assert train_rows.agg(F.avg("m")).first()[0] == pytest.approx(base, abs=1e-9)


def test_boosting_lowers_the_loss_with_every_round(run):
    losses = run.trained.models["Boosted_Trees"].losses
    assert len(losses) == 301 and losses[0] == pytest.approx(np.log(3))
    assert all(b < a for a, b in zip(losses, losses[1:]))


SMALL = boosting.BoostSettings(rounds=2, depth=3, row_share=1.0, column_share=1.0)


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, (600, 4)).astype(float)
    y = np.where(x[:, 0] + rng.normal(0, 2, 600) > 12, 2, np.where(x[:, 1] > 9, 1, 0))
    return spark.createDataFrame([(v.tolist(), float(k), i) for i, (v, k) in enumerate(zip(x, y))], "x array<double>, y double, id long")


def test_leaves_of_the_first_round_by_sql(classes):
    """Values, thresholds and numbers of rows of the first trees follow from sums that SQL adds up."""
    made = boosting.fit(classes, "x", "y", 3, replace(SMALL, rounds=1))
    t = made.trees
    rows = classes.toPandas()
    x = np.array(rows["x"].tolist())
    con = duckdb.connect()
    for k in range(3):
        leaf = t.leaves(x, k)
        known = rows[["y"]].assign(leaf=leaf)
        con.register("known", known)
        sums = con.execute(f"SELECT leaf, count(*) AS n, sum(1/3.0 - (y = {k})::INT) AS g, sum(2 * (1/3.0) * (2/3.0)) AS h FROM known GROUP BY leaf").fetchall()
        for node, n, g, h in sums:
            want = -0.05 * np.sign(g) * max(abs(g) - 0.1, 0) / (h + 1.0)
            assert t.value[node] == pytest.approx(want) and t.cover[node] == n and h >= SMALL.least_weight
    assert [len(set(t.leaves(x, k))) > 1 for k in range(3)] == [True] * 3


def test_the_first_split_is_the_best_one(classes):
    made = boosting.fit(classes, "x", "y", 3, replace(SMALL, rounds=1, depth=1)).trees
    rows = classes.toPandas()
    x, y = np.array(rows["x"].tolist()), rows["y"].to_numpy()
    score = lambda g, h: max(abs(g) - 0.1, 0) ** 2 / (h + 1)
    for k in range(3):
        g, h = 1 / 3 - (y == k), np.full(len(y), 4 / 9)
        gains = {}
        for f in range(4):
            for cut in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= cut
                if min(h[left].sum(), h[~left].sum()) >= SMALL.least_weight:
                    gains[f, cut] = score(g[left].sum(), h[left].sum()) + score(g[~left].sum(), h[~left].sum()) - score(g.sum(), h.sum())
        root = made.roots[k]
        assert made.gain[root] == pytest.approx(max(gains.values()))
        assert gains[made.feature[root], made.threshold[root]] == pytest.approx(max(gains.values()))


def test_boosting_does_not_depend_on_partitions(classes, monkeypatch):
    one = boosting.fit(classes.coalesce(1), "x", "y", 3, SMALL)
    again = boosting.fit(classes.orderBy("id").repartitionByRange(1, "id"), "x", "y", 3, SMALL)
    assert one.losses == pytest.approx(again.losses)
    parts = boosting.fit(classes.repartition(5, "id"), "x", "y", 3, SMALL)  # sums of other blocks, the same trees
    assert parts.losses == pytest.approx(one.losses)
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 1)
    assert boosting.fit(classes.coalesce(1), "x", "y", 3, SMALL).losses == pytest.approx(one.losses)


@pytest.mark.parametrize("n_classes", [2, 3])
def test_l1_model_meets_the_conditions_of_the_optimum(classes, n_classes):
    df = classes.where(F.col("y") < n_classes)
    model = sparse_logistic.fit(df, "x", "y", n_classes, 0.02)
    assert model.passes <= 15 and (model.coefficients == 0).any()
    rows = df.toPandas()
    x, y = np.array(rows["x"].tolist()), rows["y"].to_numpy().astype(int)
    z = (x - model.means) / model.spreads
    m = z @ model.coefficients.T + np.array(model.intercepts)
    p = np.exp(m) / np.exp(m).sum(axis=1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    g = p.T @ np.column_stack([np.ones(len(z)), z]) / len(y)
    b = np.column_stack([model.intercepts, model.coefficients])
    assert sparse_logistic.violation(b, g, 0.02) < 1e-4


def test_l1_model_of_two_classes_and_of_constant_columns(spark, classes):
    df = classes.select(F.concat("x", F.array(F.lit(7.0))).alias("x"), (F.col("y") == 2).cast("double").alias("y"))
    model = sparse_logistic.fit_binary(df, "x", "y", 0.01)
    assert model.coefficients.shape == (1, 5) and model.coefficients[0, 4] == 0 and model.coefficients[0, 0] > 0
    risk = df.select(model.margins(F.col("x"))[0].alias("m"), "y").toPandas()
    assert risk.loc[risk.y == 1, "m"].mean() > risk.loc[risk.y == 0, "m"].mean()
    with pytest.raises(ValueError):
        sparse_logistic.fit(df.limit(0), "x", "y", 2, 0.1)


@pytest.mark.parametrize("model", MODELS)
def test_a_scenario_without_changes_changes_nothing(run, model):
    plan = ActionPlan.of(run, model, POSITIVE)
    out = plan.what_if([Scenario("nothing", {})])
    assert out.count() == run.test.count()
    assert out.where("risk_reduction <> 0").count() == 0
    policy = plan.policies([Scenario("nothing", {})]).first()
    assert policy["prevented"] == 0 and policy["new_rate"] == policy["baseline_rate"]


def test_a_missing_model_is_named(run):
    with pytest.raises(ValueError, match="Nearest"):
        ActionPlan.of(run, "Nearest", POSITIVE)


def test_fairness_uses_labels(run):
    rates = run.audit("Boosted_Trees", ["Gender"], POSITIVE).first()
    assert 0 <= rates["disparate_impact"] < 1.0  # integers against words would give exactly 1


def test_trees_do_not_depend_on_blocks_or_their_order(classes, monkeypatch):
    """Sums are exact, so other blocks and other partitions give the same splits to the last bit."""
    one = boosting.fit(classes.coalesce(1), "x", "y", 3, replace(SMALL, rounds=4)).trees
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 37)
    many = boosting.fit(classes.repartition(3, "id"), "x", "y", 3, replace(SMALL, rounds=4)).trees
    for name in ("feature", "threshold", "left", "right", "gain"):
        assert (getattr(one, name) == getattr(many, name)).all()


def test_only_the_lighter_child_of_a_split_is_summed(classes, monkeypatch):
    places = []
    added = boosting._added

    def seen(*args):
        made = added(*args)
        if made[0].ndim == 4:
            places.append(made[0].shape[1])
        return made

    monkeypatch.setattr(boosting, "_added", seen)
    boosting.fit(classes, "x", "y", 3, replace(SMALL, rounds=1))
    assert len(places) == 3 and places[0] == 3 and places[1] <= 3 and places[2] <= 6


def _together(monkeypatch, parties):
    """Makes every fit wait until ``parties`` fits are under way."""
    gate, fit_model = threading.Barrier(parties), models.fit_model

    def fit(*args):
        gate.wait(60)
        return fit_model(*args)

    monkeypatch.setattr(models, "fit_model", fit)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(a), float(b), "u" if a > b else "v", 1 + i % 2) for i, (a, b) in enumerate(rng.random((80, 2)))]
    return spark.createDataFrame(rows, "id long, a double, b double, t string, fold int")


def test_models_are_fitted_side_by_side(table, monkeypatch):
    _together(monkeypatch, 2)
    made = train(table, "t", ["a", "b"], names=["Decision_Tree", "Logistic_L1"])
    assert list(made.models) == ["Decision_Tree", "Logistic_L1"]
    assert made.models["Logistic_L1"].coefficients.shape == (2, 2)


def test_folds_are_fitted_side_by_side(table, monkeypatch):
    _together(monkeypatch, 2)
    small = Settings(tree_leaf=1)
    held = cross_validate(table, "t", "fold", 2, ["a", "b"], settings=small, name="Decision_Tree").collect()
    assert sorted(r["id"] for r in held) == list(range(80)) and all(r["fold"] == 1 + r["id"] % 2 for r in held)
    assert sum(r["truth"] == r["pred"] for r in held) > 60


def test_rounds_of_few_rows_take_few_jobs(spark, classes, monkeypatch):
    """Rounds grown by one task, by a task a class and level by level give the same trees to the last bit."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 60)
    settings = replace(SMALL, rounds=12, row_share=0.8, column_share=0.8)
    context, made, jobs = spark.sparkContext, [], []
    for limits in ({}, {"FEW_BLOCKS": 0}, {"WHOLE_BLOCKS": 0}):
        for name, value in limits.items():
            monkeypatch.setattr(boosting, name, value)
        context.setJobGroup(f"boosting {limits}", "fit")
        made.append(boosting.fit(classes.coalesce(1), "x", "y", 3, settings))
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"boosting {limits}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] < 12 and jobs[0] < jobs[1] < 12 * 3 and jobs[2] >= 12 * 3
    for other in made[1:]:
        for name in ("feature", "threshold", "left", "right", "value", "cover", "gain", "outputs"):
            assert (getattr(other.trees, name) == getattr(made[0].trees, name)).all()
        assert other.losses == pytest.approx(made[0].losses)


def test_sums_taken_in_steps_give_the_same_trees(classes, monkeypatch):
    """However few rows are added up at a time, and whichever path grows the trees, splits stay the same to the last bit."""
    settings = replace(SMALL, rounds=10, row_share=0.8)
    one = boosting.fit(classes.coalesce(1), "x", "y", 3, settings)
    monkeypatch.setattr(boosting, "STEP_ROWS", 7)
    for whole in (boosting.WHOLE_BLOCKS, 0):
        monkeypatch.setattr(boosting, "WHOLE_BLOCKS", whole)
        many = boosting.fit(classes.coalesce(1), "x", "y", 3, settings)
        for name in ("feature", "threshold", "left", "right", "value", "cover", "gain"):
            assert (getattr(one.trees, name) == getattr(many.trees, name)).all()
        assert many.losses == pytest.approx(one.losses)


def test_rows_are_dealt_to_leaves_from_any_node_on():
    tree = boosting._Growing([0, 1, -1, -1, -1], [2, 0, 0, 0, 0], [1, 3, -1, -1, -1], [2, 4, -1, -1, -1], [0.0] * 5, [0.0] * 5)
    x = np.array([[0, 1, 3, 2, 9], [0, 1, 0, 5, 0]], np.uint8)
    assert {k: v.tolist() for k, v in tree.leaves(x).items()} == {2: [2, 4], 3: [0], 4: [1, 3]}
    assert {k: v.tolist() for k, v in tree.descend(x, {1: np.array([3, 0])}).items()} == {3: [0], 4: [3]}
    assert tree.cover(x).tolist() == [0, 0, 2, 1, 2]


def test_nodes_of_a_spark_model_are_read_once_a_class(table, monkeypatch):
    made = train(table, "t", ["a", "b"], settings=Settings(tree_leaf=1), names=["Decision_Tree"])
    read, of = [], models.trees.of_spark_model
    monkeypatch.setattr(models.trees, "of_spark_model", lambda model, place, *rest: read.append(place) or of(model, place, *rest))
    bases = [made.base("Decision_Tree", c) for c in ("u", "v", "u")]
    made.explained(table, "Decision_Tree", "u").collect()
    assert read == [0, 1] and bases[0] == bases[2] and bases[0] + bases[1] == pytest.approx(1.0)


def test_features_with_few_bins_are_counted_together():
    """One index for several features; the sums of each follow from the joint ones and are exact."""
    bins = [2, 9, 1, 64, 2, 3, 25]
    groups = boosting.joint_features(bins, 64)
    assert sorted(f for own in groups for f in own) == list(range(7)) and len(groups) == 3
    assert all(len(own) == 1 or np.prod([bins[f] for f in own]) <= 64 for own in groups)
    rng = np.random.default_rng(7)
    x = np.array([rng.integers(0, b, 500) for b in bins], np.uint8)
    both = [np.rint(rng.normal(size=500) * 2**30) / 2**30 for _ in range(2)]
    places, columns = [np.arange(0, 500, 3), np.arange(1, 500, 5)], np.array([0, 1, 3, 4, 6])
    out = np.zeros((2, 2, 5, 64))
    boosting._add_up(out, places, both, boosting._Joint.of(x, bins, groups), columns)
    for j, d in enumerate(both):
        for place, rows in enumerate(places):
            for i, f in enumerate(columns):
                assert (out[j, place, i] == np.bincount(x[f][rows], d[rows], 64)).all()


def test_blocks_of_a_task_are_summed_as_one(monkeypatch):
    monkeypatch.setattr(boosting, "GATHERED_BLOCKS", 2)
    blocks = [boosting._Block([n], [n + 1], np.full((2, n + 1), n, np.uint8), np.full(n + 1, n), np.zeros((3, n + 1))) for n in range(3)]
    one, two = boosting._gathered(iter(blocks))
    assert (one.numbers, one.sizes, two.numbers, two.sizes) == ([0, 1], [1, 2], [2], [3])
    assert one.x.tolist() == [[0, 1, 1]] * 2 and one.y.tolist() == [0, 1, 1] and one.margins.shape == (3, 3)
    apart = [len(b.sampled(0.5, 42, 0)) for b in blocks[:2]]
    assert len(one.sampled(0.5, 42, 0)) == sum(apart)


def test_forest_keeps_the_node_of_each_row(table):
    """Its jobs don't send all trees to all tasks; the forest is the same."""
    made = train(table, "t", ["a", "b"], settings=Settings(forest_trees=5, forest_leaf=1), names=["Random_Forest"]).models["Random_Forest"]
    assert made.getOrDefault("cacheNodeIds") and made.getNumTrees == 5


def test_large_places_are_summed_like_small_ones():
    """Places with more rows than twice the wide limit go alone, over other joint features, and give the same sums."""
    rng = np.random.default_rng(8)
    n, bins = 4 * boosting.WIDE_BINS, [64, 30, 2, 2, 5]
    x = np.array([rng.integers(0, b, n) for b in bins], np.uint8)
    both = rng.integers(-99, 99, n) / 64, rng.integers(0, 99, n) / 64
    places = [np.arange(n)[: 3 * boosting.WIDE_BINS], np.arange(n)[-50:], np.arange(0)]
    columns = np.array([0, 1, 3, 4])
    joints = boosting._Joints(x, bins, [boosting.joint_features(bins, limit) for limit in (boosting.JOINT_BINS, boosting.WIDE_BINS)])
    out = np.zeros((2, 3, 4, 64))
    boosting._add_up_all(out, places, both, joints, columns)
    assert sorted(joints.made) == [False, True]
    for d, values in enumerate(both):
        for i, rows in enumerate(places):
            for j, f in enumerate(columns):
                assert np.array_equal(out[d, i, j], np.bincount(x[f][rows], values[rows], 64))


def _with_vectors(classes):
    weight = F.element_at(F.array(F.lit(1.0), F.lit(2.0), F.lit(0.5)), F.col("y").cast("int") + 1)
    return classes.select(
        F.col("x").alias("_values"), array_to_vector("x").alias("_features"), F.col("y").alias("_label"), weight.alias("_weight"), "id"
    )


def test_one_tree_of_all_rows_and_features_is_sparks_tree(classes):
    """Same splits, weights, least rows and merged leaves: every row gets the probabilities of Spark's decision tree."""
    ready = _with_vectors(classes)
    s = forest.ForestSettings(trees=1, depth=5, least_rows=4, drawn=False, subset=4)
    own = forest.fit(ready.repartition(3), "_values", "_label", [1.0, 2.0, 0.5], "_features", s)
    spark_tree = DecisionTreeClassifier(
        maxDepth=5, minInstancesPerNode=4, featuresCol="_features", labelCol="_label", weightCol="_weight"
    ).fit(ready)
    assert own.totalNumNodes == spark_tree.numNodes > 7
    assert own.featureImportances.toArray() == pytest.approx(spark_tree.featureImportances.toArray())
    a, b = ([r["probability"].toArray() for r in m.transform(ready).orderBy("id").collect()] for m in (own, spark_tree))
    assert np.array(a) == pytest.approx(np.array(b))


def test_rows_of_a_forest_are_drawn_with_replacement():
    times = forest._drawn(1, 2, [0, 5], [60_000, 40_000])
    assert np.array_equal(times[60_000:], forest._drawn(1, 2, [5], [40_000]))  # a block's draws are its own
    shares = [np.mean(times == k) for k in range(4)]
    assert shares == pytest.approx([math.exp(-1) / math.factorial(k) for k in range(4)], abs=0.01)


def test_cuts_lie_between_values(spark):
    rare = [0.0] * 5 + [1.0] * 995
    rows = [([r, float(i), 7.0],) for i, r in enumerate(rare)]
    few, many, one = forest.cuts_of(spark.createDataFrame(rows, "x array<double>").repartition(3), "x", 3, 32)
    assert few.tolist() == [0.5] and one.tolist() == []
    assert len(many) == 31 and many == pytest.approx(np.arange(1, 32) * 1000 / 32, abs=5)


def test_many_rows_get_a_forest_counted_by_blocks(classes, monkeypatch, tmp_path):
    monkeypatch.setattr(models, "ROWS_PER_PARTITION", 100)
    ready = _with_vectors(classes)
    grown = []
    monkeypatch.setattr(forest, "grow", lambda *a, f=forest.grow: grown.append(f(*a)) or grown[-1])
    made = models.fit_model("Random_Forest", ready, 600, 3, Settings(forest_trees=15, forest_leaf=5))
    assert len(grown) == 1 and made.getNumTrees == 15 and made.numFeatures == 4
    hits = made.transform(ready).agg(F.avg((F.col("prediction") == F.col("_label")).cast("int"))).first()[0]
    assert hits > 0.85
    made.write().overwrite().save(str(tmp_path / "forest"))
    back = RandomForestClassificationModel.load(str(tmp_path / "forest"))
    a, b = ([tuple(r["probability"]) for r in m.transform(ready).orderBy("id").collect()] for m in (made, back))
    assert a == b
    again = models.fit_model("Random_Forest", ready, 600, 3, Settings(forest_trees=15, forest_leaf=5))
    assert [tuple(r["probability"]) for r in again.transform(ready).orderBy("id").collect()] == a


def test_nodes_counted_together_and_alone_have_the_same_counts(monkeypatch):
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 12, (5, 900)).astype(np.uint8)
    times = rng.integers(0, 3, 900).astype(float)
    found = [np.arange(0, 400), np.arange(0), np.arange(400, 900, 2), np.arange(401, 900, 2)]
    columns = np.array([[0, 2], [1, 4], [0, 3], [2, 4]])
    want = np.array([[np.bincount(codes[f][rows], times[rows], 12) for f in own] for rows, own in zip(found, columns)])
    for small, together in ((0, 1), (300, 100), (1000, 1000)):
        monkeypatch.setattr(forest, "SMALL_ROWS", small)
        monkeypatch.setattr(forest, "TOGETHER_ROWS", together)
        got = forest._counts(np.ascontiguousarray(codes.T), codes, found, times, columns, 12)
        assert np.array_equal(got, want)


def test_rows_of_trees_are_dealt_node_by_node():
    """Missing numbers go right, rows on a threshold left; a node reads one column, never whole rows."""
    x = np.array([[1.0, 5.0], [1.0, np.nan], [2.0, 0.0], [np.nan, 0.0]])
    tree = {"feature": [0, 1, LEAF, LEAF, LEAF], "threshold": [1.0, 5.0, 0, 0, 0], "left": [1, 3, -1, -1, -1], "right": [2, 4, -1, -1, -1],
            "value": [0, 0, 3.0, 1.0, 2.0], "cover": [4, 2, 2, 1, 1], "gain": [1, 1, 0, 0, 0]}
    both = joined([tree, tree], [0, 1], 2)
    read = []

    class Columns(np.ndarray):
        def __getitem__(self, at):
            read.append(at)
            return np.asarray(self)[at]

    assert both.leaves(x.view(Columns), 1).tolist() == [8, 9, 7, 7]
    assert read == [(slice(None), 0), (slice(None), 1)]
    assert both.margins(x).tolist() == [[1, 1], [2, 2], [3, 3], [3, 3]] and both.margins(x[:0]).shape == (0, 2)
