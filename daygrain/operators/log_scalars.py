"""Table-wide scalars of the cut logs, unregistered users included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from daygrain.functions.stats import aggregate
from daygrain.operators.intervals import Interval, assign_intervals


def log_scalars(days: DataFrame, intervals: Sequence[Interval]) -> DataFrame:
    """One row per interval that has any row: largest, smallest and mean day of each log, from the day table.

    The days are first counted, so the shuffle carries at most one row per (log, day) and
    task.
    """
    per_day = assign_intervals(aggregate(days, ("log", "day"), ["sum(n) AS n"]), "day", intervals)

    def mean(log: str) -> str:
        return f"sum(IF(log = '{log}', day * n, NULL)) / sum(IF(log = '{log}', n, NULL))"

    return aggregate(
        per_day,
        ["interval_id"],
        [
            "bigint(max(IF(log = 'register', day, NULL))) AS register_max",
            "bigint(min(IF(log = 'create', day, NULL))) AS create_min",
            f"{mean('create')} AS create_mean",
            f"{mean('launch')} AS launch_mean",
            "bigint(min(IF(log = 'activity', day, NULL))) AS activity_min",
        ],
    )
