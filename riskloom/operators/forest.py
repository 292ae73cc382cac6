"""Random forests of many rows on binned features, all trees grown together, level by level.

Features are cut into bins once and written as blocks of bytes.  For every level each task deals its rows, drawn with
replacement for each tree, to the tree's open nodes and counts them by (node, feature, bin, class) over the features drawn
for the node.  Counts of a tree meet in one task, which picks its splits; only these come to the driver.  Rows are
counted node by node, so that the counts stay in a cache however many nodes a level has.

Classes are weighted, counts are whole numbers, so neither tasks nor partitions change a split.  Splits, least rows and leaf
merging follow Spark's forest, and the result is a model of Spark; only the draws and the cuts are others.
"""

from __future__ import annotations

import json
import math
import pickle
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators.boosting import BLOCKS_PER_PARTITION, STEP_ROWS, blocks_of
from riskloom.operators.trees import LEAF
from riskloom.session import shared_path, stage

FINE = 1024  # ranks, evenly apart, that cuts are chosen from
SORTED_ROWS = 1 << 16
SMALL_ROWS, TOGETHER_ROWS = 1 << 8, 1 << 13  # of a node that is counted with others, and of all these
DRAW_BITS = 16  # of the table of draws
# how many of 2^16 equally likely draws take a row once at most, twice at most, ...
TIMES = np.repeat(
    np.arange(9.0),
    np.diff([0, *[round(2**DRAW_BITS * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(8)], 2**DRAW_BITS]),
)


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 200
    depth: int = 10
    least_rows: int = 30
    bins: int = 32
    seed: int = 42
    drawn: bool = True  # rows with replacement; else every tree learns from all
    subset: int | None = None  # features a node; by default the root of their number


@dataclass
class _Tree:
    """Splits on bins; children come behind their parent.  ``counts`` are the drawn rows of each class."""

    feature: list[int] = field(default_factory=lambda: [LEAF])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [LEAF])
    right: list[int] = field(default_factory=lambda: [LEAF])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    counts: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)])

    def add(self, counts: np.ndarray) -> int:
        for own, new in zip((self.feature, self.cut, self.left, self.right, self.gain), (LEAF, 0, LEAF, LEAF, -1.0)):
            own.append(new)
        self.counts.append(counts)
        return len(self.feature) - 1


@dataclass(frozen=True)
class _Open:
    """What a task needs of a tree: its splits, its open nodes, and the features (node, place) drawn for them."""

    feature: list[int]
    cut: list[int]
    left: list[int]
    right: list[int]
    nodes: list[int]
    columns: np.ndarray

    def dealt(self, x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        """The rows of each open node."""
        found = {0: rows}
        for node, feature in enumerate(self.feature):
            if feature != LEAF and node in found:
                rows = found.pop(node)
                low = x[feature].take(rows) <= self.cut[node]
                found[self.left[node]], found[self.right[node]] = rows.compress(low), rows.compress(~low)
        return [found[node] for node in self.nodes]


def _ranked(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``FINE`` + 1 evenly spaced quantiles of each feature, (feature, rank); a value stands for so many rows."""
    order = values.argsort(axis=1, kind="stable")
    values = np.take_along_axis(values, order, 1)
    upto = np.broadcast_to(rows, values.shape)
    upto = np.take_along_axis(upto, order, 1).cumsum(axis=1)
    at = np.arange(FINE + 1) / FINE
    places = [np.searchsorted(own, at * own[-1] * (1 - 1e-12), "left") for own in upto]
    return np.array([own[np.minimum(place, len(own) - 1)] for own, place in zip(values, places)])


def cuts_of(df: DataFrame, values: str, width: int, bins: int) -> list[np.ndarray]:
    """Ascending cuts of each feature, half way between two values: next to all values where these are at most ``bins``, else
    at evenly spaced ranks.  All rows are sorted, some at a time, and their ranks merged in each task and on the driver."""

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = [], []

        def close(held: list[np.ndarray]) -> None:
            x = np.concatenate(held)
            found.append(_ranked(np.ascontiguousarray(x.T), np.ones(len(x))))
            rows.append(len(x))

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width))
            if sum(map(len, held)) >= SORTED_ROWS:
                close(held)
                held = []
        if sum(map(len, held)):
            close(held)
        if found:
            own = found[0] if len(found) == 1 else _merged(found, rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([sum(rows)], pa.int64()), pa.array([own.tobytes()], pa.binary())], names=["rows", "ranks"]
            )

    made = df.select(values).mapInArrow(ranks, "rows long, ranks binary").collect()
    found = _merged([np.frombuffer(r["ranks"]).reshape(width, FINE + 1) for r in made], [r["rows"] for r in made])
    cuts = []
    for own in found:
        distinct = np.unique(own)
        low = distinct if len(distinct) <= bins else np.unique(own[[FINE * i // bins for i in range(1, bins)]])
        low = low[low < distinct[-1]]
        high = distinct[np.searchsorted(distinct, low, "right")]
        between = low + (high - low) / 2
        cuts.append(np.where((between >= low) & (between < high), between, low))
    return cuts


def _merged(found: Sequence[np.ndarray], rows: Sequence[int]) -> np.ndarray:
    return _ranked(np.concatenate(found, axis=1), np.repeat(np.array(rows, float) / (FINE + 1), FINE + 1))


def _drawn(seed: int, tree: int, numbers: Sequence[int], sizes: Sequence[int]) -> np.ndarray:
    """How often the tree takes each row of the blocks: nearly Poisson of mean 1, as rows drawn with replacement are."""
    parts = [np.random.default_rng((seed, tree, number)).integers(0, 2**DRAW_BITS, n, np.uint16) for number, n in zip(numbers, sizes)]
    return TIMES.take(np.concatenate(parts))


def _counted(codes: np.ndarray, rows: np.ndarray, times: np.ndarray, columns: Sequence[int], size: int) -> np.ndarray:
    """(columns, codes): the rows of a node, each as often as drawn, some at a time so that they stay in a cache."""
    out = np.zeros((len(columns), size))
    for lo in range(0, len(rows), STEP_ROWS):
        own = rows[lo : lo + STEP_ROWS]
        often = times.take(own)
        for place, f in enumerate(columns):
            out[place] += np.bincount(codes[f].take(own), often, size)
    return out


def _counted_together(
    codes: np.ndarray, found: Sequence[np.ndarray], times: np.ndarray, columns: np.ndarray, size: int
) -> np.ndarray:
    """(nodes, columns, codes): rows of several small nodes in one go.  ``codes`` hold the features of a row side by side."""
    (n, k), rows = columns.shape, np.concatenate(found)
    node = np.repeat(np.arange(n), [len(own) for own in found])
    at = columns.take(node, axis=0)
    at += (rows * codes.shape[1])[:, None]
    place = codes.ravel().take(at) + (np.arange(n * k) * size).reshape(n, k).take(node, axis=0)
    return np.bincount(place.ravel(), np.repeat(times.take(rows), k), n * k * size).reshape(n, k, size)


def _counts(
    by_row: np.ndarray, by_feature: np.ndarray, found: Sequence[np.ndarray], times: np.ndarray, columns: np.ndarray, size: int
) -> np.ndarray:
    """(nodes, columns, codes): a large node feature by feature, small ones together, ``TOGETHER_ROWS`` rows at a time."""
    out = np.empty((*columns.shape, size))
    held: list[int] = []
    rows = 0

    def close() -> None:
        if held:
            out[held] = _counted_together(by_row, [found[i] for i in held], times, columns[held], size)
            held.clear()

    for i, own in enumerate(found):
        if len(own) > SMALL_ROWS:
            out[i] = _counted(by_feature, own, times, columns[i].tolist(), size)
            continue
        if rows + len(own) > TOGETHER_ROWS:
            close()
            rows = 0
        held.append(i)
        rows += len(own)
    close()
    return out


def _smallest(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _impurity(counts: np.ndarray) -> np.ndarray:
    """Gini impurity over the last axis."""
    total = np.maximum(counts.sum(axis=-1, keepdims=True), 1e-300)
    return 1.0 - ((counts / total) ** 2).sum(axis=-1)


def _best(counts: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(place of the feature, bin, gain, class counts left, class counts) of the best split of each node; the gain is -1
    where none leaves enough rows on both sides.  ``counts`` are (nodes, places, bins, classes)."""
    upto = counts.cumsum(axis=2)
    whole, low = upto[:, 0, -1], upto[:, :, :-1]
    high = upto[:, :, -1:] - low
    weigh = lambda part: (part * weights).sum(axis=-1)
    all_weight = np.maximum(weigh(whole), 1e-300)[:, None, None]
    gain = _impurity(whole * weights)[:, None, None] - (
        weigh(low) * _impurity(low * weights) + weigh(high) * _impurity(high * weights)
    ) / all_weight
    gain[np.minimum(low.sum(axis=-1), high.sum(axis=-1)) < least] = -1.0
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    place, cut = np.divmod(at, gain.shape[2])
    rows = np.arange(len(gain))
    return place, cut, flat[rows, at], low[rows, place, cut], whole


def _level(held: DataFrame, parts: int, opened: dict[int, _Open], width: int, s: ForestSettings, weights: np.ndarray) -> dict:
    """The best splits of the open nodes of all trees."""
    spark, n_classes, n_trees = held.sparkSession, len(weights), len(opened)
    sent = spark.sparkContext.broadcast(opened)  # bounded by the size of the model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, sizes, x, y = [], [], [], []
        for batch in batches:
            for r in batch.to_pylist():
                numbers.append(r["number"])
                sizes.append(r["rows"])
                x.append(np.ascontiguousarray(np.frombuffer(r["bins"], np.uint8).reshape(r["rows"], width).T))
                y.append(np.frombuffer(r["labels"], np.uint16))
        if not sizes:
            return
        x, y = np.concatenate(x, axis=1), np.concatenate(y)
        size = s.bins * n_classes
        codes = x.astype(np.min_scalar_type(size)) * n_classes + y.astype(np.min_scalar_type(size))
        by_row = np.ascontiguousarray(codes.T)
        for tree, own in sent.value.items():
            times = _drawn(s.seed, tree, numbers, sizes) if s.drawn else np.ones(len(y))
            found = own.dealt(x, np.flatnonzero(times))
            out = _smallest(_counts(by_row, codes, found, times, own.columns, size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree], pa.int32()), pa.array([out.dtype.str]), pa.array([out.tobytes()], pa.binary())],
                names=["tree", "kind", "counts"],
            )

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                own = sent.value[r["tree"]]
                counts = np.frombuffer(r["counts"], r["kind"]).reshape(*own.columns.shape, s.bins, n_classes)
                if r["tree"] in sums:
                    sums[r["tree"]] += counts
                else:
                    sums[r["tree"]] = counts.astype(np.int64)
        for tree, counts in sums.items():
            found = [np.concatenate(part) for part in zip(*[_best(counts[lo : lo + 64], weights, s.least_rows) for lo in range(0, len(counts), 64)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree], pa.int32()), pa.array([pickle.dumps(found)], pa.binary())], names=["tree", "found"]
            )

    counts = held.repartition(parts).mapInArrow(count, "tree int, kind string, counts binary")
    tasks = min(n_trees, max(parts, spark.sparkContext.defaultParallelism))
    rows = counts.repartition(tasks, "tree").mapInArrow(pick, "tree int, found binary").collect()
    sent.unpersist()
    return {r["tree"]: pickle.loads(r["found"]) for r in rows}


def grow(df: DataFrame, values: str, label: str, weights: Sequence[float], settings: ForestSettings) -> tuple[list[_Tree], list[np.ndarray]]:
    """The trees, and the cuts of each feature.  ``label`` holds class numbers, ``weights`` the weight of each class."""
    s, spark = settings, df.sparkSession
    head = df.select(F.size(values)).first()
    if head is None:
        raise ValueError("no rows to learn from")
    width = head[0]
    cuts = cuts_of(df, values, width, s.bins)
    blocks = blocks_of(df, values, label, cuts).withColumn("number", F.monotonically_increasing_id())
    held = stage(blocks, "blocks")
    n_blocks = held.count()
    parts = max(1, min(n_blocks, max(spark.sparkContext.defaultParallelism, -(-n_blocks // BLOCKS_PER_PARTITION))))
    taken = min(width, s.subset or math.ceil(math.sqrt(width)))
    trees = [_Tree() for _ in range(s.trees)]
    open_nodes: list[list[int]] = [[0] for _ in trees]
    weight = np.array(weights, np.float64)
    for depth in range(s.depth):
        opened = {}
        for t, (tree, nodes) in enumerate(zip(trees, open_nodes)):
            if nodes:
                order = np.random.default_rng((s.seed, depth, t)).random((len(nodes), width)).argsort(axis=1)
                columns = np.sort(order[:, :taken], axis=1)
                opened[t] = _Open(tree.feature, tree.cut, tree.left, tree.right, nodes, columns)
        if not opened:
            break
        for t, (place, cut, gain, low, whole) in _level(held, parts, opened, width, s, weight).items():
            tree, nodes, columns = trees[t], open_nodes[t], opened[t].columns
            if depth == 0:
                tree.counts[0] = whole[0]
            open_nodes[t] = []
            for i in np.flatnonzero(gain > 0).tolist():
                node = nodes[i]
                tree.feature[node], tree.cut[node], tree.gain[node] = int(columns[i, place[i]]), int(cut[i]), float(gain[i])
                for side, counts in ((tree.left, low[i]), (tree.right, whole[i] - low[i])):
                    side[node] = child = tree.add(counts)
                    # what is pure or small stays a leaf
                    if counts.sum() >= 2 * s.least_rows and np.count_nonzero(counts) > 1:
                        open_nodes[t].append(child)
    return trees, cuts


def _node_table(trees: list[_Tree], cuts: Sequence[np.ndarray], weights: np.ndarray) -> pa.Table:
    """Nodes as Spark's models save them; leaves with one parent that predict the same class are merged, as there."""
    columns: dict[str, list] = {n: [] for n in (
        "treeID", "id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "featureIndex", "threshold"
    )}
    for t, tree in enumerate(trees):
        counts = np.array(tree.counts)
        stats = counts * weights
        said, impurity = stats.argmax(axis=1), _impurity(stats)
        leaf = [f == LEAF for f in tree.feature]
        for node in range(len(leaf) - 1, -1, -1):
            if not leaf[node] and leaf[tree.left[node]] and leaf[tree.right[node]]:
                leaf[node] = bool(said[tree.left[node]] == said[tree.right[node]])
        kept = [0]
        for node in kept:  # grows as it goes
            if not leaf[node]:
                kept += [tree.left[node], tree.right[node]]
        place = {node: i for i, node in enumerate(kept)}
        for i, node in enumerate(kept):
            f, c = tree.feature[node], tree.cut[node]
            inner = not leaf[node]
            row = (
                t, i, float(said[node]), float(impurity[node]), stats[node].tolist(), int(counts[node].sum()),
                tree.gain[node] if inner else -1.0,
                place[tree.left[node]] if inner else -1, place[tree.right[node]] if inner else -1,
                f if inner else -1, [float(cuts[f][min(c, len(cuts[f]) - 1)])] if inner else [],
            )
            for own, value in zip(columns.values(), row):
                own.append(value)
    kinds = {"treeID": pa.int32(), "id": pa.int32(), "leftChild": pa.int32(), "rightChild": pa.int32(), "featureIndex": pa.int32(),
             "rawCount": pa.int64(), "impurityStats": pa.list_(pa.float64()), "threshold": pa.list_(pa.float64())}
    return pa.table({n: pa.array(own, kinds.get(n, pa.float64())) for n, own in columns.items()})


def _metadata(spark: SparkSession, kind: str, uid: str, params: dict, **more) -> str:
    return json.dumps(
        {"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
         "uid": uid, "paramMap": params, "defaultParamMap": {}, **more}
    )


def as_spark_model(
    spark: SparkSession, trees: list[_Tree], cuts: Sequence[np.ndarray], weights: Sequence[float], features: str, s: ForestSettings
) -> RandomForestClassificationModel:
    """The forest as Spark's own model, read from the files such a model saves."""
    path, weight = shared_path(spark, "forest"), np.array(weights, np.float64)
    nodes = spark.createDataFrame(_node_table(trees, cuts, weight))
    split = F.struct("featureIndex", F.col("threshold").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    names = ("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild")
    nodes.select("treeID", F.struct(*names, split.alias("split")).alias("nodeData")).write.parquet(f"{path}/data")
    own = {"featuresCol": features, "predictionCol": "prediction", "probabilityCol": "probability", "rawPredictionCol": "rawPrediction",
           "maxDepth": s.depth, "minInstancesPerNode": s.least_rows, "maxBins": s.bins, "seed": s.seed}
    kept = [(t, _metadata(spark, "DecisionTreeClassificationModel", f"dtc_{uuid.uuid4().hex[:12]}", own), 1.0) for t in range(len(trees))]
    spark.createDataFrame(kept, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    sizes = {"numFeatures": len(cuts), "numClasses": len(weight), "numTrees": len(trees)}
    params = own | {"numTrees": len(trees), "featureSubsetStrategy": "sqrt", "impurity": "gini", "bootstrap": s.drawn}
    whole = _metadata(spark, "RandomForestClassificationModel", f"RandomForestClassifier_{uuid.uuid4().hex[:12]}", params, **sizes)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)


def fit(
    df: DataFrame, values: str, label: str, weights: Sequence[float], features: str, settings: ForestSettings = ForestSettings()
) -> RandomForestClassificationModel:
    """Grow on the array ``values``; the model reads the vector ``features`` of the same numbers."""
    trees, cuts = grow(df, values, label, weights, settings)
    return as_spark_model(df.sparkSession, trees, cuts, weights, features, settings)
