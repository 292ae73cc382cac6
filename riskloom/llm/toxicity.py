"""Toxicity scores by a character n-gram linear classifier with naive Bayes log-count ratios.

A text's features are its hashed byte n-grams: the logarithm of one more than a gram's count, times the log ratio of the
gram's smoothed document frequencies in toxic and in other texts, the whole vector scaled to length 1.  A linear support vector machine on these features is fitted on the driver from at most
``max_rows`` labelled texts (those of least key hash, the documented bound); its margins become scores by a logistic
curve fitted on margins of folds left out; ratios and choice of features are made anew for each fold, too, so these
margins owe nothing to the texts they belong to.  Scoring runs on whole texts in the tasks that read them.

Defined results: a null or empty text has no feature, its score comes from the intercept alone; repeated rows are
scored each for itself; without labels of both kinds every score is the share of label 1 (0.5 without any labels); an
empty table gives an empty result; columns other than the key and the text are not read when scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm import bytesops

SIZES = (4, 5, 6, 7)
BITS = 20
MAX_ROWS = 6_000
MIN_DOCS = 4  # a feature is in so many training texts at least
MIN_RATIO = 1.0  # and its log ratio is so far from 0
FOLDS = 4


def features(texts: list[bytes | None], sizes=SIZES, bits: int = BITS, used=None) -> Iterator[tuple]:
    """(distinct n-gram buckets, their weights) of each text, of ``used`` buckets only if given."""
    for grams in bytesops.text_ngrams(texts, sizes, bits):
        found, count = np.unique(
            np.concatenate(grams if used is None else [g[used[g]] for g in grams]), return_counts=True
        )
        yield found, np.log2(1 + count)


@dataclass
class Model:
    ratios: np.ndarray  # of each bucket, 0 if unused
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    sizes: tuple[int, ...] = SIZES
    bits: int = BITS

    def margins(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for i, (found, count) in enumerate(features(texts, self.sizes, self.bits, self.ratios != 0)):
            x = self.ratios[found] * count
            if len(x):
                out[i] += self.weights[found] @ x / np.linalg.norm(x)
        return out

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -500, 500)))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, chosen: Column, max_rows: int) -> list[tuple]:
    """(text, 0 or 1) of at most ``max_rows`` labelled documents for which ``chosen`` (on doc_id) holds.

    Only keys travel until the sample is known; of several labels of one document the largest counts, of
    several texts of one id the least.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("key"), F.col(label).cast("int").alias("y"))
        .filter(F.col("key").isNotNull() & F.col("y").isin(0, 1))
        .groupBy("key")
        .agg(F.max("y").alias("y"))
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    taken = known.withColumnRenamed("key", "doc_id").filter(chosen).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # at most max_rows keys of 8 bytes: small whatever the input
    rows = texts.join(F.broadcast(taken), "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    table = rows.toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return list(zip(bytesops.texts_of(table.column("text").combine_chunks()), table.column("y").to_pylist()))


def _svm(rows: list[tuple], signs: np.ndarray, size: int, cost: np.ndarray, rounds: int = 12) -> tuple:
    """Weights and bias of a linear SVM with squared hinge loss, by coordinate descent on its dual."""
    rng = np.random.default_rng(7)
    w, b = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([v @ v + 1 for _, v in rows])
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            (r, v), s = rows[i], signs[i]
            gradient = s * (w[r] @ v + b) - 1 + alpha[i] / (2 * cost[i])
            new = max(alpha[i] - gradient / (square[i] + 1 / (2 * cost[i])), 0.0)
            step = (new - alpha[i]) * s
            if step:
                w[r] += step * v
                b += step
                alpha[i] = new
    return w, b


def _logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve, by Newton steps on slightly smoothed targets."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def log_ratios(counts: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log ratio of smoothed document frequencies in texts of label 1 and 0; 0 for features that aren't used."""
    out = np.log((counts[1] + 0.5) / (y.sum() + 1)) - np.log((counts[0] + 0.5) / ((1 - y).sum() + 1))
    return np.where((counts.sum(0) >= MIN_DOCS) & (np.abs(out) >= MIN_RATIO), out, 0.0).astype(np.float32)


def _scaled(x: tuple, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values of length 1) of a text's (buckets, counts)."""
    buckets, count = x
    buckets, count = buckets[ratio[buckets] != 0], count[ratio[buckets] != 0]
    v = count * ratio[buckets]
    return buckets, v / max(np.linalg.norm(v), 1e-9)


def fit(rows: list[tuple], sizes=SIZES, bits: int = BITS) -> Model:
    y = np.array([r[1] for r in rows], float)
    share = (y.sum() + 1) / (len(y) + 2)
    empty = np.zeros(1 << bits, np.float32)
    flat = Model(empty, empty, 0.0, 1.0, float(np.log(share / (1 - share))), sizes, bits)
    if min(y.sum(), (1 - y).sum()) < FOLDS:
        return flat
    fold = np.arange(len(rows)) % FOLDS
    counts = np.zeros((FOLDS, 2, 1 << bits), np.int32)
    for at in range(0, len(rows), 64):
        for i, (f, _) in enumerate(features([t for t, _ in rows[at : at + 64]], sizes, bits), at):
            counts[fold[i], int(y[i])][f] += 1
    total = counts.sum(0)
    ratio = log_ratios(total, y)
    left_out = [log_ratios(total - counts[k], y[fold != k]) for k in range(FOLDS)]
    kept = np.any([ratio, *left_out], axis=0)  # used with any of the folds left out
    if not ratio.any():
        return flat
    # counts of these features only, so that all texts fit
    found = [
        x
        for at in range(0, len(rows), 64)
        for x in features([t for t, _ in rows[at : at + 64]], sizes, bits, kept)
    ]
    signs = 2 * y - 1
    cost = np.where(y == 1, (1 - y).sum() / y.sum(), 1.0)
    margins = np.zeros(len(rows))
    for k in range(FOLDS):
        inside = np.flatnonzero(fold != k)
        scaled = [_scaled(x, left_out[k]) for x in found]
        w, b = _svm([scaled[i] for i in inside], signs[inside], 1 << bits, cost[inside])
        for i in np.flatnonzero(fold == k):
            margins[i] = w[scaled[i][0]] @ scaled[i][1] + b
    w, b = _svm([_scaled(x, ratio) for x in found], signs, 1 << bits, cost)
    slope, shift = _logistic(margins, y)
    return Model(ratio, w.astype(np.float32), float(b), slope, shift, sizes, bits)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every row; the model's size is fixed, whatever the input."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in bytesops.blocks(batch, "text"):
                s = shared.value.scores(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(texts)),
                        pa.array(s, pa.float64()),
                        pa.array((s >= threshold).astype(np.int32)),
                    ],
                    names=["doc_id", "score", "predicted"],
                )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, "doc_id bigint, score double, predicted int")
