"""Counts taken as rows pass, beside a job's result."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def how_many(condition: Column) -> Column:
    return F.count_if(condition)


class Counts:
    """Counts of what a job leaves out or reads, ready when the job has run.

    ``watch`` puts them on a step of the job; ``totals`` adds up those of one name. A step
    that was run again because an executor was lost counts once; one that Spark found to
    have no input counts nothing.
    """

    #: Seconds ``totals`` waits for a step's counts to arrive.
    PATIENCE = 5.0

    def __init__(self):
        self._steps: list[tuple[Observation, tuple[str, ...]]] = []

    def watch(self, rows: DataFrame, **counted: Column) -> DataFrame:
        step = Observation()
        self._steps.append((step, tuple(counted)))
        return rows.observe(step, *[c.cast("bigint").alias(name) for name, c in counted.items()])

    def totals(self) -> dict[str, int]:
        found: dict[str, int] = {}
        until = time.monotonic() + self.PATIENCE
        for step, names in self._steps:
            while not step._jo.future().isCompleted() and time.monotonic() < until:
                time.sleep(0.02)
            got = step.get if step._jo.future().isCompleted() else {}
            for name in names:
                found[name] = found.get(name, 0) + (got.get(name) or 0)
        return found


def watched(rows: DataFrame, counts: Counts | None, **counted: Column) -> DataFrame:
    return counts.watch(rows, **counted) if counts is not None else rows
