"""Populations, active ids and 0/1 labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from daygrain.functions.stats import aggregate
from daygrain.operators.intervals import Interval, assign_label_weeks, assign_populations, membership_parts

KEYS = ("interval_id", "user_id")


def active_ids(stacked: DataFrame, intervals: Sequence[Interval]) -> DataFrame:
    """Distinct (interval_id, user_id) seen in a label week; registering is not activity."""
    rows = stacked.where("log <> 'register'").select("user_id", "day")
    return assign_label_weeks(rows, "day", intervals).select(*KEYS).distinct()


def distinct_ids(*logs: DataFrame) -> DataFrame:
    """Union of the ``user_id`` columns of the given logs, without duplicates."""
    return reduce(DataFrame.union, [df.select("user_id") for df in logs]).distinct()


def population(stacked: DataFrame, intervals: Sequence[Interval]) -> DataFrame:
    """Distinct (interval_id, user_id) of the users each interval describes."""
    rows = stacked.where("log = 'register'").select("user_id", "day")
    return assign_populations(rows, "day", intervals).select(*KEYS).distinct()


def labels(stacked: DataFrame, intervals: Sequence[Interval]) -> DataFrame:
    """``interval_id, user_id, label`` for the intervals that have a label week.

    Members and active users meet in one aggregate, combined map-side: no join.
    """
    labelled = [iv for iv in intervals if iv.label_begin is not None]
    parts = stacked.selectExpr(membership_parts(labelled), "user_id")
    flags = ["int(max(part = 'label')) AS label", "max(part = 'population') AS member"]
    return aggregate(parts, KEYS, flags).where("member").drop("member")
