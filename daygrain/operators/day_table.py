"""The day table: one row per (log, user, day), and the windows over a user's days.

Every per-user statistic but the distinct counts follows from this table. The first
aggregate combines map-side, so a user with a third of all rows reaches the shuffle as
one row per day and task; afterwards a user has at most one row per day, so no window
below can meet a large group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from daygrain.functions.stats import aggregate
from daygrain.operators.intervals import Interval, assign_intervals, parts_of_day
from daygrain.sources.logs import ACTION_TYPES, PAGES

# A user's rows of one log within one interval.
GROUP = ("interval_id", "user_id", "part")
# Rows of the cut day table per task, from its windows to the features: their sorts and aggregates take up to 5 KB a row.
ROWS_PER_TASK = 1 << 17


def day_table(stacked: DataFrame) -> DataFrame:
    """Row counts, first and last ``seq``, and code counts per (log, user, day)."""
    return aggregate(
        stacked,
        ("log", "user_id", "day"),
        [
            "count(*) AS n",
            "min(seq) AS first_seq",
            "max(seq) AS last_seq",
            "count(page) AS n_page",
            "count(action_type) AS n_action",
            *[f"count_if(page = {p}) AS page_{p}" for p in PAGES],
            *[f"count_if(action_type = {a}) AS action_type_{a}" for a in ACTION_TYPES],
        ],
    )


def cut_days(days: DataFrame, intervals: Sequence[Interval]) -> DataFrame:
    """The day table with each row once per feature interval that contains its day."""
    return assign_intervals(days, "day", intervals).withColumnRenamed("log", "part")


def cut_days_into_parts(days: DataFrame, intervals: Sequence[Interval]) -> DataFrame:
    """Like ``cut_days``, with the label weeks and populations as two more parts."""
    return days.selectExpr(parts_of_day(intervals), "*").drop("log")


def tasks_for(days: DataFrame, rows: int = ROWS_PER_TASK) -> int | None:
    """Tasks of at most about ``rows`` rows for the cut ``days``, which are counted; None if one task may have them all.

    The day table must be stored, so that counting reads it and not the logs.
    """
    n = days.count()
    return max(-(-n // rows), days.sparkSession.sparkContext.defaultParallelism) if n > rows else None


def by_user(df: DataFrame, tasks: int | None) -> DataFrame:
    """``df`` hashed on (interval, user) over a given number of tasks, or over as many as Spark likes."""
    return df.repartition(*[tasks] if tasks else [], "interval_id", "user_id")


def with_day_windows(days: DataFrame, tasks: int | None = None) -> DataFrame:
    """Add what the gap, rank and streak statistics need, with one shuffle and one sort.

    ``step`` is the distance to the user's previous day, ``day_rank`` the dense rank
    with the latest day first. ``run_days`` is set on the last day of each streak: a
    streak is a maximal series of row-to-row differences of 1, so a repeated day (n > 1)
    ends it. ``file_step`` is the distance to the day before in file order, where the days
    may come in any order; ``mixed`` marks a day that begins before the rows of such a day end.

    The rows are hashed on (interval, user) rather than on the whole group, so that the
    parts of a user can later be put side by side, and joined, without another shuffle. They are
    dealt over ``tasks`` (see ``tasks_for``): Spark joins shuffle partitions by their compressed
    size, of which a task needs some fifty times as much memory.
    """
    whole = f"PARTITION BY {', '.join(GROUP)}"
    by_day, so_far = f"{whole} ORDER BY day", f"{whole} ORDER BY day ROWS UNBOUNDED PRECEDING"
    by_file = f"{whole} ORDER BY first_seq"
    neighbours = f"""
        SELECT *,
          row_number() OVER ({by_day}) AS nth,
          day - lag(day) OVER ({by_day}) AS step,
          lag(day) OVER ({by_day}) - lag(day, 2) OVER ({by_day}) AS step_before,
          lead(day) OVER ({by_day}) - day AS step_after,
          lag(n) OVER ({by_day}) AS n_before,
          sum(n) OVER ({so_far}) AS rows_so_far
        FROM {{days}}
    """
    links = """
        SELECT *,
          coalesce(step = 1 AND step_before = 1 AND n_before = 1, false) AS goes_on,
          coalesce(step = 1 AND NOT (coalesce(step_after = 1, false) AND n = 1), false) AS ends
        FROM {neighbours}
    """
    runs = f"""
        SELECT * EXCEPT (nth, step_before, step_after, n_before, goes_on, ends),
          count(*) OVER ({whole}) - nth + 1 AS day_rank,
          sum(n) OVER ({whole}) AS rows_total,
          IF(ends, nth + 2 - max(IF(goes_on, NULL, nth)) OVER ({so_far}), NULL) AS run_days
        FROM {{links}}
    """
    in_file = f"""
        SELECT *, day - lag(day) OVER ({by_file}) AS file_step, {mixed_days(by_file)} AS mixed
        FROM {{days}}
    """
    sql = days.sparkSession.sql
    days = by_user(days, tasks)
    return sql(runs, links=sql(links, neighbours=sql(neighbours, days=sql(in_file, days=days))))


def mixed_days(by_file: str) -> str:
    """SQL: the day's first row stands before the last one of a day that begins earlier; ``by_file`` orders a user's days by first row."""
    return f"first_seq <= max(last_seq) OVER ({by_file} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
