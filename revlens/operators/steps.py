"""Row counts between the steps of a job, taken by the job itself.

``StepCounts.after`` marks a point of a plan. The rows that pass it are counted while an action
runs that would run anyway; nothing is read or computed again. Counts are read after that action.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def rows_of(spark: SparkSession, counts: Mapping[str, int], name: str) -> DataFrame:
    """Counts as rows ``name, n``, part of the plan itself."""
    rows = F.array(*(F.struct(F.lit(key), F.lit(n)) for key, n in counts.items()))
    return spark.range(1).select(F.inline(rows.cast(f"array<struct<{name}: string, n: bigint>>")))


class StepCounts:
    """Counts at named points of one plan, for one action.

    A point in front of a shuffle counts rows again that are computed again because an executor
    was lost; its count is then too high, while points behind the last shuffle stay exact. A point
    counts nothing where the plan's optimizer can tell that no row gets there.
    """

    def __init__(self) -> None:
        self._points: list[tuple[str, Observation, str]] = []

    def after(self, step: str, df: DataFrame, **parts: Column) -> DataFrame:
        """``df`` itself, with its rows counted as ``step``, and those that meet a condition as its name.

        Several counts of one point are taken in one go. A name is given once in a plan.
        """
        names = [step, *parts]
        taken = {name for name, _, _ in self._points}
        if taken & set(names):
            raise ValueError(f"steps are counted already: {sorted(taken & set(names))}")
        point = Observation()
        counted = [F.count(F.lit(1)), *(F.count_if(part) for part in parts.values())]
        self._points += [(name, point, f"n{i}") for i, name in enumerate(names)]
        return df.observe(point, *(count.alias(f"n{i}") for i, count in enumerate(counted)))

    def read(self) -> dict[str, int]:
        """The counts in the order of their points; waits for the action that takes them."""
        return {name: point.get.get(key, 0) for name, point, key in self._points}

    def table(self, spark: SparkSession) -> DataFrame:
        """The counts as rows ``step, n``."""
        return rows_of(spark, self.read(), "step")
