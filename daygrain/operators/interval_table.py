"""Intervals as data: any number of them, from a table.

A table of intervals (``COLUMNS``) is turned into the days that each one uses, and rows meet
their intervals in a join on the day. The days of all intervals are broadcast while they are few,
which is counted first; beyond that the join is shuffled by day and salt, since a log has few days and
many rows of each. The plan is the same for three intervals and for thousands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions.stats import aggregate
from daygrain.operators.intervals import Interval

COLUMNS = "interval_id int, begin int, end int, label_begin int, label_end int, registered_by int"
# (Interval, day) pairs up to which the days of all intervals are broadcast, and the salts of a day beyond it.
MOST_BROADCAST, SALTS = 1 << 20, 32


def interval_table(spark: SparkSession, intervals: Sequence[Interval]) -> DataFrame:
    """Given intervals as a table."""
    rows = [(iv.interval_id, iv.begin, iv.end, iv.label_begin, iv.label_end, iv.registered_by) for iv in intervals]
    return spark.createDataFrame(rows, COLUMNS)


def rolling_intervals(rows: DataFrame, count: int, width: int, label_width: int) -> DataFrame:
    """``count`` intervals of ``width`` days, from the first ``day`` of ``rows`` to the last, spread evenly.

    Each has its label days right behind it and takes the users registered by its end.
    """
    span = rows.agg(F.min("day").alias("first"), F.max("day").alias("last")).where("first IS NOT NULL")
    return (
        span.selectExpr("first", "last", f"explode(sequence(0, {count - 1})) AS i")
        .selectExpr("int(i + 1) AS interval_id", f"int(first + i * greatest(last - first - {width - 2}, 1) div {count}) AS begin")
        .selectExpr(
            "interval_id", "begin", f"begin + {width - 1} AS end", f"begin + {width} AS label_begin",
            f"begin + {width + label_width - 1} AS label_end", f"begin + {width - 1} AS registered_by",
        )
    )


def feature_days(intervals: DataFrame) -> DataFrame:
    """``day, interval_id, last_day``: the feature days of every interval."""
    return intervals.where("begin <= end").selectExpr(
        "explode(sequence(begin, end)) AS day", "interval_id", "end AS last_day"
    )


def label_days(intervals: DataFrame) -> DataFrame:
    """``day, interval_id, last_day``: the label days of the intervals that have them."""
    return intervals.where("label_begin <= label_end").selectExpr(
        "explode(sequence(label_begin, label_end)) AS day", "interval_id", "end AS last_day"
    )


def population_days(intervals: DataFrame, register: DataFrame) -> DataFrame:
    """``day, interval_id, last_day``: days of ``register`` (``day``) on which users of each interval registered.

    An interval without a bound takes all of them.
    """
    span = register.agg(F.min("day").alias("first"), F.max("day").alias("last"))  # one row
    bounds = intervals.join(F.broadcast(span)).selectExpr("*", "least(coalesce(registered_by, last), last) AS bound")
    more = [c for c in intervals.columns if c not in COLUMNS.replace(" int", "").split(", ")]
    return bounds.where("first <= bound").selectExpr(
        "explode(sequence(first, bound)) AS day", "interval_id", "end AS last_day", *more
    )


def assign(df: DataFrame, days: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """One row per (row of ``df``, interval that uses its ``day``), with ``interval_id`` and ``last_day``."""
    if days.count() <= most:
        return df.join(F.broadcast(days), "day")
    salted = days.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")
    return df.withColumn("salt", salt).join(salted, ["day", "salt"]).drop("salt")


def cut_days_by_table(days: DataFrame, intervals: DataFrame) -> DataFrame:
    """The day table with each row once per feature interval that contains its day, and ``last_day``."""
    return assign(days, feature_days(intervals)).withColumnRenamed("log", "part")


def labels_by_table(stacked: DataFrame, intervals: DataFrame) -> DataFrame:
    """``interval_id, user_id, label`` for the intervals that have a label week.

    Users are first reduced to one row with their first registration and the days they were active, of which there
    are no more than days of the log. Only that row meets the intervals, and carries all that tells the label:
    the rows of users and intervals, by far the most, are neither shuffled nor aggregated.
    """
    days = stacked.selectExpr("user_id", "log = 'register' AS registers", "day").distinct()
    sides = ["min(IF(registers, day, NULL)) AS day", "collect_list(IF(registers, NULL, day)) AS active"]
    users = aggregate(days, ["user_id"], sides).where("day IS NOT NULL")
    acted = "exists(weeks, w -> exists(active, d -> d BETWEEN w.begin AND w.end))"
    weeks = _weeks_by_population_day(intervals.where("label_begin IS NOT NULL"), stacked.where("log = 'register'"))
    return assign(users, weeks).selectExpr("interval_id", "user_id", f"int(coalesce({acted}, false)) AS label")


def _weeks_by_population_day(intervals: DataFrame, register: DataFrame) -> DataFrame:
    """``day, interval_id, weeks``: population days, with the label weeks (``begin, end``) of the interval; rows of one id are one."""
    weeks = aggregate(
        intervals,
        ["interval_id"],
        [
            "max(end) AS end",
            "IF(count(*) > count(registered_by), NULL, max(registered_by)) AS registered_by",
            "collect_list(named_struct('begin', label_begin, 'end', label_end)) AS weeks",
        ],
    )
    return population_days(weeks, register).drop("last_day")
