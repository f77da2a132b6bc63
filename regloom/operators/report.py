"""Row counts of a cleaning step and durations of batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def percent_removed(before: Column, after: Column) -> Column:
    """Share of rows removed, in percent; null for an empty input."""
    return F.round(F.try_divide(before - after, before) * 100, 2)


def removal_report(df: DataFrame, kept: Column) -> DataFrame:
    """Rows before and after a filter, and the percentage removed, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(kept).alias("rows_after")
    )
    return counts.withColumn(
        "pct_removed", percent_removed(F.col("rows_before"), F.col("rows_after"))
    )


class RowCounts:
    """Rows meeting a condition at points of a plan, counted by the action that runs it."""

    def __init__(self) -> None:
        self._observations: list[Observation] = []

    def count(self, df: DataFrame, **conditions: Column) -> DataFrame:
        """Count rows under each name by its condition, all in one step of the plan."""
        self._observations.append(Observation())
        counts = [F.count_if(condition).alias(name) for name, condition in conditions.items()]
        return df.observe(self._observations[-1], *counts)

    def values(self) -> dict[str, int]:
        """The counts; to be read once the action is over."""
        return {name: n for seen in self._observations for name, n in seen.get.items()}

    def report(self) -> dict[str, float | None]:
        """The counts and the percentage removed between ``before`` and ``after``."""
        counts = self.values()
        before, after = counts["rows_before"], counts["rows_after"]
        removed = round((before - after) / before * 100, 2) if before else None
        return {**counts, "pct_removed": removed}


def duration_stats(batches: DataFrame) -> DataFrame:
    """Number of batches, total and mean seconds per flow.

    Summed as decimals, so the result does not depend on the order of addition.
    """
    seconds = F.col("seconds").cast("decimal(18,2)")
    return batches.groupBy("flow").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum(seconds).cast("double").alias("total_seconds"),
        F.round(F.sum(seconds).cast("double") / F.count(seconds), 2).alias("mean_seconds"),
    )
