"""Sets of decision trees as arrays: margins of rows, and what each feature adds along the decision paths.

Trees of any origin are held alike: boosted ones as they are grown here (``boosting``), those of Spark's models as read
from the nodes they save.  A node carries the mean output of the training rows that reach it, so the steps from a tree's
root to a leaf split the leaf's output among the features that were asked on the way.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions.expr import col

LEAF = -1
FIELDS = {
    "feature": ("int", np.int32),
    "threshold": ("double", np.float64),
    "left": ("int", np.int32),
    "right": ("int", np.int32),
    "value": ("double", np.float64),
    "cover": ("double", np.float64),
    "gain": ("double", np.float64),
}


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees; ``feature`` is ``LEAF`` in leaves, whose ``value`` is the output.

    A row goes left where its feature is at most the threshold.  ``value`` of an inner node is the mean output of the
    training rows below it, ``cover`` their number or weight.  ``roots`` are the trees' first nodes, ``outputs`` which
    output (class) each tree adds to, out of ``n_outputs``.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    roots: np.ndarray
    outputs: np.ndarray
    n_outputs: int

    def leaves(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The leaf each row of ``x`` ends in; rows are dealt node by node, so a node reads one column of its rows."""
        out = np.empty(len(x), self.roots.dtype)
        found = [(int(self.roots[tree]), np.arange(len(x)))]
        while found:
            node, rows = found.pop()
            if self.feature[node] == LEAF:
                out[rows] = node
            elif len(rows):
                low = x[:, self.feature[node]].take(rows) <= self.threshold[node]
                found += [(int(self.left[node]), rows.compress(low)), (int(self.right[node]), rows.compress(~low))]
        return out

    def margins(self, x: np.ndarray) -> np.ndarray:
        out, x = np.zeros((len(x), self.n_outputs)), np.asfortranarray(x)
        for tree, output in enumerate(self.outputs.tolist()):
            out[:, output] += self.value[self.leaves(x, tree)]
        return out

    def base(self, output: int) -> float:
        """The mean margin of the training rows."""
        return float(self.value[self.roots[self.outputs == output]].sum())

    def contributions(self, x: np.ndarray, output: int) -> np.ndarray:
        """(rows, features): the steps of the paths, added up by the feature asked; a row's sum is its margin less the
        base."""
        out = np.zeros_like(x, dtype=np.float64)
        rows = np.arange(len(x))
        for tree in np.flatnonzero(self.outputs == output).tolist():
            at = np.full(len(x), self.roots[tree])
            while True:
                inner = self.feature[at] != LEAF
                if not inner.any():
                    break
                asked = np.maximum(self.feature[at], 0)
                to = np.where(x[rows, asked] <= self.threshold[at], self.left[at], self.right[at])
                to = np.where(inner, to, at)
                out[rows, asked] += self.value[to] - self.value[at]
                at = to
        return out

    def importances(self, n_features: int) -> np.ndarray:
        """Mean gain of the splits of each feature, scaled to add up to 1."""
        inner = self.feature != LEAF
        total = np.bincount(self.feature[inner], self.gain[inner], n_features)
        times = np.bincount(self.feature[inner], minlength=n_features)
        mean = total / np.maximum(times, 1)
        return mean / mean.sum() if mean.sum() else mean

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(tree, output, node, feature, threshold, left, right, value, cover, gain); children of leaves are -1."""
        ends = np.append(self.roots[1:], len(self.feature))
        tree = np.repeat(np.arange(len(self.roots)), ends - self.roots)
        rows = zip(
            tree.tolist(), self.outputs[tree].tolist(), range(len(tree)), *[getattr(self, n).tolist() for n in FIELDS]
        )
        fields = ", ".join(f"{n} {kind}" for n, (kind, _) in FIELDS.items())
        return spark.createDataFrame(list(rows), f"tree int, output int, node int, {fields}")

    @classmethod
    def of_nodes(cls, nodes: DataFrame, n_outputs: int) -> Trees:
        """Read back what ``nodes`` gives; the size of a model bounds what is collected."""
        rows = nodes.orderBy("node").toPandas()
        roots = np.flatnonzero(np.diff(rows["tree"].to_numpy(), prepend=-1))
        arrays = [rows[n].to_numpy().astype(kind) for n, (_, kind) in FIELDS.items()]
        return cls(*arrays, roots.astype(np.int32), rows["output"].to_numpy()[roots].astype(np.int32), n_outputs)


def joined(parts: Sequence[dict[str, np.ndarray]], outputs: Sequence[int], n_outputs: int) -> Trees:
    """One set of trees from the arrays of each, with children numbered from 0 inside each tree."""
    sizes = np.array([len(p["feature"]) for p in parts], np.int64)
    roots = np.cumsum(sizes) - sizes
    arrays = {n: np.concatenate([np.asarray(p[n], kind) for p in parts]) for n, (_, kind) in FIELDS.items()}
    shift = np.repeat(roots, sizes)
    for side in ("left", "right"):
        arrays[side] = np.where(arrays[side] >= 0, arrays[side] + shift, LEAF).astype(np.int32)
    return Trees(**arrays, roots=roots.astype(np.int32), outputs=np.asarray(outputs, np.int32), n_outputs=n_outputs)


def of_spark_model(model, output: int, spark: SparkSession, path: str) -> Trees:
    """A Spark tree or forest classifier as trees whose margin is the probability of class ``output``.

    The nodes are read from what the model itself saves below ``path``: class weights per node give its mean output.
    """
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data")
    if "nodeData" in rows.columns:
        rows = rows.select("treeID", "nodeData.*")
    else:
        rows = rows.select(F.lit(0).alias("treeID"), "*")
    rows = rows.select(
        "treeID", "id", "gain", "leftChild", "rightChild", "split.featureIndex",
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), "impurityStats",
    ).orderBy("treeID", "id").toPandas()
    parts = []
    n_trees = rows["treeID"].nunique()
    for _, own in rows.groupby("treeID", sort=True):
        stats = np.array(own["impurityStats"].tolist(), np.float64)
        cover = stats.sum(axis=1)
        leaf = own["leftChild"].to_numpy() < 0
        parts.append(
            {
                "feature": np.where(leaf, LEAF, own["featureIndex"]),
                "threshold": np.where(leaf, 0.0, own["threshold"].astype(float).fillna(0.0)),
                "left": own["leftChild"].to_numpy(),
                "right": own["rightChild"].to_numpy(),
                "value": stats[:, output] / np.maximum(cover, 1e-300) / n_trees,
                "cover": cover,
                "gain": np.where(leaf, 0.0, own["gain"]),
            }
        )
    return joined(parts, [0] * n_trees, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _appended(df: DataFrame, values: str, new: str, work) -> DataFrame:
    """``df`` with the array column ``new`` that ``work`` makes from the matrix of the array column ``values``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = work(_matrix(batch.column(batch.schema.names.index(values))))
            ends = np.arange(len(made) + 1, dtype=np.int32) * made.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, new])

    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(new, T.ArrayType(T.DoubleType()))])
    return df.mapInArrow(run, schema)


def with_margins(df: DataFrame, trees: Trees, values: str, name: str) -> DataFrame:
    """Add the array of margins, one per output, of the rows' feature array."""
    sent = df.sparkSession.sparkContext.broadcast(trees)  # bounded by the size of the model
    return _appended(df, values, name, lambda x: sent.value.margins(x))


def with_contributions(df: DataFrame, trees: Trees, output: int, values: str, features: Sequence[str]) -> DataFrame:
    """Add ``contributions`` (feature, value, contribution) of one output for each feature, in their order."""
    sent = df.sparkSession.sparkContext.broadcast(trees)
    steps = _appended(df, values, "_steps", lambda x: sent.value.contributions(x, output))
    parts = [
        F.struct(
            F.lit(f).alias("feature"), col(values)[i].alias("value"), F.col("_steps")[i].alias("contribution")
        )
        for i, f in enumerate(features)
    ]
    return steps.withColumn("contributions", F.array(*parts)).drop("_steps")
