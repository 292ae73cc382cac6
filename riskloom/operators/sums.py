"""Sums of small matrices over all rows, in one pass: what Newton steps and correlations need of a table."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BATCH_ROWS = 8192
DIRECT = 16  # tasks whose sums go to the driver at once; more are added up in stages


def matrix_sums(
    df: DataFrame, columns: Sequence[Column], work: Callable[[np.ndarray], list[np.ndarray]]
) -> list[np.ndarray] | None:
    """The sums of ``work`` over all rows, None if there are none.

    ``columns`` are numbers; nulls come as NaN.  ``work`` gets blocks of rows as a matrix of doubles and gives arrays
    whose size does not depend on the rows.  Every task adds up its own, so only these arrays are moved.
    """
    names = [f"c{i}" for i in range(len(columns))]

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(lo, BATCH_ROWS)
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in part.columns])
                made = work(x)
                total = made if total is None else [a + b for a, b in zip(total, made)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["sums"])

    numbers = df.select(*[c.cast("double").alias(n) for c, n in zip(columns, names)])
    sums = numbers.mapInArrow(inside, "sums binary").rdd.map(lambda r: pickle.loads(r[0]))
    plus = lambda a, b: [x + y for x, y in zip(a, b)]
    if sums.getNumPartitions() > DIRECT:
        sums = sums.mapPartitions(_folded(plus)).coalesce(max(DIRECT, sums.getNumPartitions() // DIRECT))
        sums = sums.mapPartitions(_folded(plus))
    found = sums.collect()
    total = None
    for own in found:
        total = own if total is None else plus(total, own)
    return total


def _folded(plus):
    def fold(parts):
        total = None
        for own in parts:
            total = own if total is None else plus(total, own)
        return [] if total is None else [total]

    return fold


def elements(values: str, width: int) -> list[Column]:
    """The places of an array column as columns."""
    return [F.col(values)[i] for i in range(width)]
