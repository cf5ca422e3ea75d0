"""Day intervals: the cut of a log, and the assignment of rows to overlapping intervals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Interval:
    """Feature days ``begin..end`` (``end`` is also the reference day of the offsets).

    The label days and the registration bound are None for an interval that is only
    scored: its population is every registered user.
    """

    interval_id: int
    begin: int
    end: int
    label_begin: int | None = None
    label_end: int | None = None
    registered_by: int | None = None


# The three intervals (train, validation, score).
INTERVALS = (
    Interval(1, 1, 16, 17, 23, registered_by=16),
    Interval(2, 8, 23, 24, 30, registered_by=23),
    Interval(3, 15, 30),
)


def day_span(intervals: Sequence[Interval]) -> tuple[int, int]:
    """First and last day that any interval reads, label days included."""
    ends = [iv.end for iv in intervals] + [iv.label_end for iv in intervals if iv.label_end is not None]
    begins = [iv.begin for iv in intervals] + [iv.label_begin for iv in intervals if iv.label_begin is not None]
    return min(begins), max(ends)


def last_day(intervals: Sequence[Interval] | None) -> str:
    """SQL for the reference day of the row's ``interval_id``; the column ``last_day`` for rows that carry it."""
    if intervals is None:
        return "last_day"
    return "CASE interval_id " + " ".join(f"WHEN {iv.interval_id} THEN {iv.end}" for iv in intervals) + " END"


def cut(df: DataFrame, day: str, begin: int, end: int) -> DataFrame:
    """Rows whose day lies in the closed range."""
    return df.where(F.col(day).between(begin, end))


def _one_row_per_use(uses: Sequence[tuple[str, int, str]]) -> str:
    """SQL generator: a row ``interval_id, part`` for each (condition, interval, part) that holds."""
    structs = [f"IF({cond}, named_struct('interval_id', {i}, 'part', {part}), NULL)" for cond, i, part in uses]
    return f"inline(array_compact(array({', '.join(structs)})))"


def _assign(df: DataFrame, uses: Sequence[tuple[str, int, str]]) -> DataFrame:
    return df.selectExpr(_one_row_per_use(uses), "*").drop("part")


def assign_intervals(df: DataFrame, day: str, intervals: Sequence[Interval]) -> DataFrame:
    """One row per (row, feature interval that contains its day), with ``interval_id``.

    The few intervals are literals, so a row meets them in a generator inside its own
    task: no join, and no shuffle.
    """
    return _assign(df, [(f"{day} BETWEEN {iv.begin} AND {iv.end}", iv.interval_id, "''") for iv in intervals])


def assign_label_weeks(df: DataFrame, day: str, intervals: Sequence[Interval]) -> DataFrame:
    """Like ``assign_intervals``, for the label days."""
    weeks = [iv for iv in intervals if iv.label_begin is not None]
    return _assign(df, [(_label_days(day, iv), iv.interval_id, "''") for iv in weeks])


def assign_cuts(df: DataFrame, day: str, intervals: Sequence[Interval]) -> DataFrame:
    """One row per (row, cut that contains its day), with ``interval_id`` and ``cut``.

    ``cut`` is ``features`` or, of the intervals that have one, ``label``: five cuts for the
    three intervals.
    """
    cuts = [(f"{day} BETWEEN {iv.begin} AND {iv.end}", iv.interval_id, "'features'") for iv in intervals]
    weeks = [iv for iv in intervals if iv.label_begin is not None]
    cuts += [(_label_days(day, iv), iv.interval_id, "'label'") for iv in weeks]
    return df.selectExpr(_one_row_per_use(cuts), "*").withColumnRenamed("part", "cut")


def assign_populations(register: DataFrame, day: str, intervals: Sequence[Interval]) -> DataFrame:
    """One row per (register row, interval whose registration bound it meets)."""
    return _assign(register, [(_registered(day, iv), iv.interval_id, "''") for iv in intervals])


def membership_parts(intervals: Sequence[Interval]) -> str:
    """SQL generator of ``interval_id, part`` for a row with ``log`` and ``day``.

    ``part`` is ``label`` for an activity day in the label week, ``population`` for a
    registration within the bound.
    """
    return _one_row_per_use(_membership(intervals))


def parts_of_day(intervals: Sequence[Interval]) -> str:
    """Like ``membership_parts``, with the log's name as the part of its feature days.

    One pass over the day table then feeds features, labels and populations alike.
    """
    features = [(f"day BETWEEN {iv.begin} AND {iv.end}", iv.interval_id, "log") for iv in intervals]
    return _one_row_per_use(features + _membership(intervals))


def _membership(intervals: Sequence[Interval]) -> list[tuple[str, int, str]]:
    uses = [(f"log = 'register' AND {_registered('day', iv)}", iv.interval_id, "'population'") for iv in intervals]
    weeks = [iv for iv in intervals if iv.label_begin is not None]
    return uses + [(f"log <> 'register' AND {_label_days('day', iv)}", iv.interval_id, "'label'") for iv in weeks]


def _label_days(day: str, iv: Interval) -> str:
    return f"{day} BETWEEN {iv.label_begin} AND {iv.label_end}"


def _registered(day: str, iv: Interval) -> str:
    return "true" if iv.registered_by is None else f"{day} <= {iv.registered_by}"
