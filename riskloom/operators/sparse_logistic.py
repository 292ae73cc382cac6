"""L1 logistic regression of any number of classes by proximal Newton steps.

The objective is the weighted mean of the log loss plus ``penalty`` times the sizes of all coefficients; intercepts go
free.  A step needs one pass over the rows, which adds up the gradient and the weighted Gram matrices of all pairs of
classes; the quadratic problem with its penalty, as large as the features and not the rows, is solved on the driver by
coordinate descent.  A full step that does not lower the objective enough is halved, several halves measured in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.operators.sums import elements, matrix_sums

TOLERANCE = 1e-7  # of the optimality conditions
MOST_PASSES = 60
HALVES = np.array([0.5, 0.25, 0.125, 0.0625, 0.03125])


@dataclass(frozen=True)
class LinearModel:
    """Margins of every class on standardised features; features without spread have no coefficient."""

    means: Sequence[float]
    spreads: Sequence[float]
    coefficients: np.ndarray  # (classes, features), of standardised values
    intercepts: Sequence[float]
    penalty: float
    passes: int

    def margins(self, values: Column) -> list[Column]:
        """One column per class from an array of features."""
        out = []
        for own, start in zip(self.coefficients, self.intercepts):
            terms = [
                (values[i] - F.lit(float(self.means[i]))) * F.lit(float(w / self.spreads[i]))
                for i, w in enumerate(own)
                if w and self.spreads[i]
            ]
            out.append(reduce(lambda a, b: a + b, terms, F.lit(float(start))))
        return out

    def rows(self, spark: SparkSession, features: Sequence[str]) -> DataFrame:
        """(output, place, feature, mean, spread, coefficient); the intercept stands at place -1."""
        rows = []
        for k, own in enumerate(self.coefficients.tolist()):
            rows.append((k, -1, None, 0.0, 1.0, float(self.intercepts[k])))
            rows += [
                (k, i, f, float(self.means[i]), float(self.spreads[i]), w) for i, (f, w) in enumerate(zip(features, own))
            ]
        return spark.createDataFrame(
            rows, "output int, place int, feature string, mean double, spread double, coefficient double"
        )

    @classmethod
    def of_rows(cls, rows: DataFrame) -> LinearModel:
        found = rows.orderBy("output", "place").toPandas()
        classes = found["output"].nunique()
        table = found["coefficient"].to_numpy().reshape(classes, -1)
        first = found[(found["output"] == 0) & (found["place"] >= 0)]
        return cls(first["mean"].tolist(), first["spread"].tolist(), table[:, 1:], table[:, 0].tolist(), 0.0, 0)


def probabilities(margins: Column) -> Column:
    """Softmax of an array of margins."""
    top = F.array_max(margins)
    each = F.transform(margins, lambda m: F.exp(m - top))
    total = F.aggregate(each, F.lit(0.0), lambda a, x: a + x)
    return F.transform(each, lambda e: e / total)


def _derivatives(b: np.ndarray, mean: np.ndarray, spread: np.ndarray, classes: int):
    """Loss, gradient and Gram matrices of the rows of a block, as one function of the block."""
    p = len(mean)

    def work(x: np.ndarray) -> list[np.ndarray]:
        y, w = x[:, p].astype(np.int64), x[:, p + 1]
        z = np.column_stack([np.ones(len(x)), (x[:, :p] - mean) / spread])
        m = z @ b.T
        m -= m.max(axis=1, keepdims=True)
        e = np.exp(m)
        total = e.sum(axis=1)
        q = e / total[:, None]
        rows = np.arange(len(x))
        loss = (w * (np.log(total) - m[rows, y])).sum()
        off = q.copy()
        off[rows, y] -= 1
        gram = np.empty((classes, classes, p + 1, p + 1))
        for k in range(classes):
            for j in range(k, classes):
                weight = w * q[:, k] * ((k == j) - q[:, j])
                gram[k, j] = z.T @ (z * weight[:, None])
                gram[j, k] = gram[k, j]
        return [np.array(loss), (off * w[:, None]).T @ z, gram]

    return work


def _losses(bs: list[np.ndarray], mean: np.ndarray, spread: np.ndarray):
    p = len(mean)

    def work(x: np.ndarray) -> list[np.ndarray]:
        y, w = x[:, p].astype(np.int64), x[:, p + 1]
        z = np.column_stack([np.ones(len(x)), (x[:, :p] - mean) / spread])
        out = []
        for b in bs:
            m = z @ b.T
            m -= m.max(axis=1, keepdims=True)
            out.append((w * (np.log(np.exp(m).sum(axis=1)) - m[np.arange(len(x)), y])).sum())
        return [np.array(out)]

    return work


def violation(b: np.ndarray, gradient: np.ndarray, penalty: float) -> float:
    """How far coefficients (intercepts first) are from the conditions of the optimum."""
    size, g = b[:, 1:], gradient[:, 1:]
    off = np.where(size != 0, np.abs(g + penalty * np.sign(size)), np.maximum(np.abs(g) - penalty, 0.0))
    return float(max(off.max(initial=0.0), np.abs(gradient[:, 0]).max(initial=0.0)))


def _direction(b: np.ndarray, gradient: np.ndarray, gram: np.ndarray, penalty: float) -> np.ndarray:
    """The step that is best for the quadratic model with the penalty, by coordinate descent."""
    classes, width = b.shape
    n = b.size
    h = gram.transpose(0, 2, 1, 3).reshape(n, n) + 1e-9 * np.eye(n)
    g, start = gradient.ravel(), b.ravel()
    free = np.zeros((classes, width), bool)
    free[:, 0] = True
    # single numbers are read from lists: that takes a fraction of the time of reading them from arrays
    free, first, diagonal = free.ravel().tolist(), start.tolist(), np.diag(h).tolist()
    d, slope = [0.0] * n, g.copy()
    for _ in range(2000):
        most = 0.0
        for i in range(n):
            old = first[i] + d[i]
            at = old - float(slope[i]) / diagonal[i]
            if free[i]:
                new = at
            else:
                size = abs(at) - penalty / diagonal[i]
                new = 0.0 if size <= 0.0 else size if at > 0.0 else -size
            step = new - old
            if step:
                d[i] += step
                slope += step * h[i]
                most = max(most, abs(step) * diagonal[i])
        if most < TOLERANCE / 10:
            break
    return np.array(d).reshape(classes, width)


def fit(
    df: DataFrame, values: str, label: str, n_classes: int, penalty: float, weight: str | None = None
) -> LinearModel:
    """Fit on the feature array ``values`` and class numbers ``label``; ``penalty`` is that of the mean loss."""
    head = df.select(F.size(values)).first()
    if head is None:
        raise ValueError("no rows to learn from")
    p = head[0]
    own = elements(values, p)
    w = F.col(weight) if weight else F.lit(1.0)
    facts = df.agg(
        F.sum(w).alias("w"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(own)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(own)],
    ).first()
    mean = np.array([facts[f"m{i}"] for i in range(p)], float)
    spread = np.array([facts[f"s{i}"] or 0.0 for i in range(p)], float)
    flat = ~(spread > 0)  # standardised to 0, so nothing is learnt of them
    divisor = np.where(flat, np.inf, spread)
    columns = [*own, F.col(label), w]
    total = float(facts["w"])
    # two classes need one margin; the other one is 0
    b = np.zeros((n_classes, p + 1))
    passes = 1

    def measured(at: np.ndarray):
        nonlocal passes
        passes += 1
        loss, gradient, gram = matrix_sums(df, columns, _derivatives(at, mean, divisor, n_classes))
        return float(loss) / total, gradient / total, gram / total

    size = lambda at: penalty * np.abs(at[:, 1:]).sum()
    loss, gradient, gram = measured(b)
    while passes < MOST_PASSES and violation(b, gradient, penalty) > TOLERANCE:
        d = _direction(b, gradient, gram, penalty)
        gain = (gradient * d).sum() + size(b + d) - size(b)
        before = loss + size(b)
        new_loss, new_gradient, new_gram = measured(b + d)
        if new_loss + size(b + d) > before + 1e-4 * gain + 1e-13:
            passes += 1
            tried = [b + t * d for t in HALVES]
            found = matrix_sums(df, columns, _losses(tried, mean, divisor))[0] / total
            good = [t for t, x, at in zip(HALVES, found, tried) if x + size(at) <= before + 1e-4 * t * gain]
            if not good:
                break  # no lower value within the precision of the sums
            d = good[0] * d
            new_loss, new_gradient, new_gram = measured(b + d)
        b, loss, gradient, gram = b + d, new_loss, new_gradient, new_gram
    b[:, 0] -= b[:, 0].mean()
    return LinearModel(mean.tolist(), np.where(flat, 0.0, spread).tolist(), b[:, 1:], b[:, 0].tolist(), penalty, passes)


def fit_binary(df: DataFrame, values: str, label: str, penalty: float, weight: str | None = None) -> LinearModel:
    """Two classes with one coefficient per feature, that of class 1: the other class's margin is 0.

    The penalty counts this coefficient alone, as is usual for two classes; with a margin for each class the same
    difference would be split in two halves that together cost as much, so coefficients are those differences.
    """
    both = fit(df, values, label, 2, penalty, weight)
    return LinearModel(
        both.means,
        both.spreads,
        both.coefficients[1:] - both.coefficients[:1],
        [both.intercepts[1] - both.intercepts[0]],
        penalty,
        both.passes,
    )
