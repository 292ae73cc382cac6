"""Shares of every closed week against all weeks before it, on a stream.

The rows are counted per week and outcome first; a week's counts leave that aggregate together, once the watermark has
passed its end.  Only these counts, a row per week and outcome, meet the keyed state that holds the totals, so the
state and its one task per group stay small however many rows the stream has.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.functions.expr import col
from riskloom.streaming.intake import on_disk_state, weekly_counts


class RunningShares(StatefulProcessor):
    """Keeps (outcome -> rows so far) of a group; each week is compared with it and then added."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getMapState("totals", "outcome string", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        counts = pd.concat(list(rows), ignore_index=True)
        before = {k[0]: v[0] for k, v in self.totals.iterator()}
        out = []
        for week, part in counts.groupby("week", sort=True):
            now = {k: int(n) for k, n in part.groupby("outcome")["n"].sum().items()}
            all_now, all_before = sum(now.values()), sum(before.values())
            if all_before:
                for outcome in sorted(before.keys() | now.keys()):
                    this = now.get(outcome, 0) * 100.0 / all_now
                    cum = before.get(outcome, 0) * 100.0 / all_before
                    out.append((*key, week, outcome, this, cum, this - cum))
            for outcome, n in now.items():
                before[outcome] = before.get(outcome, 0) + n
                self.totals.updateValue((outcome,), (before[outcome],))
        yield pd.DataFrame(out, columns=["segment", "week", "outcome", "this_pct", "cum_pct", "delta_pct"])

    def close(self) -> None:
        pass


def cumulative_drift(stream: DataFrame, time: str, target: str, lateness: str = "1 day") -> DataFrame:
    """(week, target, this_pct, cum_pct, delta_pct) of every closed week but the first, in append mode.

    Gives what ``operators.drift.drift_vs_cumulative`` gives for the closed weeks.  Rows without outcome don't count;
    rows later than the watermark are dropped before the weeks are counted; a week without rows is no week.
    """
    on_disk_state(stream.sparkSession)
    known = stream.where(col(target).isNotNull())
    counts = weekly_counts(known, time, target, lateness).select(
        F.lit("all").alias("segment"), "week", col(target).cast("string").alias("outcome"), "n"
    )
    drift = counts.groupBy("segment").transformWithStateInPandas(
        statefulProcessor=RunningShares(),
        outputStructType="segment string, week string, outcome string, this_pct double, cum_pct double, delta_pct double",
        outputMode="Append",
        timeMode="None",
    )
    return drift.drop("segment").withColumnRenamed("outcome", target)
