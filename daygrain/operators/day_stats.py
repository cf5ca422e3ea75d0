"""Per-user statistics over the cut day table.

Each function returns the SQL aggregates of one operator and the outputs computed from
them; an operator can be run alone with ``summarise``, and the feature plan runs all of
them in a single aggregate. Missing is NULL, never 0. Statistics that refer to the interval's last
day take the intervals, or None for days that carry it as ``last_day``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from daygrain.functions.stats import aggregate, ratio, sample_skewness, sample_stddev
from daygrain.operators.day_table import GROUP, with_day_windows
from daygrain.operators.intervals import Interval, last_day
from daygrain.sources.logs import ACTION_TYPES, PAGES

OFFSETS = (1, 2, 3, 4, 5, 6)
# Window length in days -> weight of its row count.
TRAILING_WEIGHTS = {3: 0.7, 5: 0.3, 7: 0.1}


@dataclass(frozen=True)
class Stats:
    """Named SQL aggregates over the days of a group, and outputs as SQL over those names.

    An output is NULL where its aggregates are: a user without rows has no statistics.
    """

    aggregates: dict[str, str]
    outputs: dict[str, str]

    def __or__(self, other: Stats) -> Stats:
        return Stats(self.aggregates | other.aggregates, self.outputs | other.outputs)

    def output_of(self, name: str, prefix: str) -> tuple[str, set[str]]:
        """An output over prefixed aggregate names, and the aggregates it uses."""
        used = set(re.findall(r"\w+", self.outputs[name])) & set(self.aggregates)
        return re.sub(r"\w+", lambda m: prefix + m[0] if m[0] in used else m[0], self.outputs[name]), used


def _same(aggregates: dict[str, str]) -> Stats:
    return Stats(aggregates, {name: name for name in aggregates})


def _power_sums(name: str, value: str, weight: str = "1") -> dict[str, str]:
    return {f"{name}_s{power}": f"sum({' * '.join([value] * power)} * {weight})" for power in (1, 2, 3)}


def day_stats() -> Stats:
    """Row count, largest, smallest, mean and last (in file order) day; distinct days."""
    aggregates = {
        "row_count": "sum(n)",
        "day_max": "max(day)",
        "day_min": "min(day)",
        "day_sum": "sum(day * n)",
        "day_last": "max_by(day, last_seq)",
        "day_count": "count(day)",
    }
    return Stats(
        aggregates,
        {
            "count": "row_count",
            "max": "bigint(day_max)",
            "min": "bigint(day_min)",
            "mean": "day_sum / row_count",
            "last": "bigint(day_last)",
            "uni": "day_count",
            "radio": ratio("day_count", "row_count"),
        },
    )


def recency(intervals: Sequence[Interval] | None) -> Stats:
    """Days from the user's latest day to the interval's last day."""
    if intervals is None:
        return Stats({"since": "min(last_day - day)"}, {"recency": "bigint(since)"})
    return Stats({"day_max": "max(day)"}, {"recency": f"bigint({last_day(intervals)} - day_max)"})


def gap_stats() -> Stats:
    """Statistics of the gap to the user's previous row in file order, where rows of two days don't mix.

    Then a day's first row has the gap ``file_step`` (0 for the very first) and its other
    rows have 0. A group with a mixed day gets NULLs and ``out_of_order`` true;
    ``gaps.late_gap_stats`` covers exactly those from the rows themselves.
    """
    step = "bigint(coalesce(file_step, 0))"
    aggregates = {
        "row_count": "sum(n)",
        "broken": "coalesce(max(mixed), false)",
        "gap_max": f"max(IF(n > 1, greatest({step}, 0), {step}))",
        "gap_min": f"min(IF(n > 1, least({step}, 0), {step}))",
        "gap_last": f"max_by(IF(n > 1, 0, {step}), last_seq)",
        **_power_sums("gap", step),
    }
    outputs = {
        "diff_max": "gap_max",
        "diff_min": "gap_min",
        "diff_mean": "gap_s1 / row_count",
        "diff_ske": sample_skewness("row_count", "gap_s1", "gap_s2", "gap_s3"),
        "diff_last": "gap_last",
    }
    in_order = {name: f"IF(broken, NULL, {sql})" for name, sql in outputs.items()}
    return Stats(aggregates, {"out_of_order": "broken"} | in_order)


def rank_stats() -> Stats:
    """Statistics of the row-wise dense rank of the day (1 = latest), weighted by rows per day."""

    def at_row(position: str) -> str:
        # rows_so_far counts from the earliest day: the earliest day to reach the row holds it
        return f"max(IF(rows_so_far >= {position}, day_rank, NULL))"

    aggregates = {
        "row_count": "sum(n)",
        "rank_high": "max(day_rank)",
        "rank_low": "min(day_rank)",
        "rank_final": "max_by(day_rank, last_seq)",
        "rank_lower_middle": at_row("(rows_total + 1) div 2"),
        "rank_upper_middle": at_row("rows_total div 2 + 1"),
        **_power_sums("rank", "day_rank", "n"),
    }
    return Stats(
        aggregates,
        {
            "rank_count": "row_count",
            "rank_max": "bigint(rank_high)",
            "rank_min": "bigint(rank_low)",
            "rank_mean": "rank_s1 / row_count",
            "rank_median": "(rank_lower_middle + rank_upper_middle) / 2d",
            "rank_skew": sample_skewness("row_count", "rank_s1", "rank_s2", "rank_s3"),
            "rank_std": sample_stddev("row_count", "rank_s1", "rank_s2"),
            "rank_last": "bigint(rank_final)",
        },
    )


def volume_variance() -> Stats:
    """Sample variance of the rows per active day."""
    return _same({"volume_var": "var_samp(n)"})


def daily_profile() -> Stats:
    """Spread of the daily number of non-null pages and action types."""
    functions = {"max": "max", "min": "min", "mean": "avg", "std": "stddev_samp"}
    return _same(
        {
            f"day_{code}_count_{name}": f"{function}(n_{code})"
            for code in ("page", "action")
            for name, function in functions.items()
        }
    )


def _code_shares(counts: Sequence[str], shares: Sequence[str], kinds: str) -> Stats:
    sums = {f"{c}_sum": f"sum({c})" for c in counts}
    total = f"({' + '.join(sums)})"
    return Stats(
        sums,
        {c: f"nullif({s}, 0)" for c, s in zip(counts, sums)}
        | {share: ratio(s, total) for share, s in zip(shares, sums)}
        | {kinds: f"bigint({' + '.join(f'int({s} > 0)' for s in sums)})"},
    )


def page_shares() -> Stats:
    """Count (NULL when absent) and share (0 when absent) of each page; distinct pages."""
    return _code_shares([f"page_{p}" for p in PAGES], [f"page{p}_percent" for p in PAGES], "page_nui")


def action_shares() -> Stats:
    """Count and share of each action type; distinct action types."""
    counts = [f"action_type_{a}" for a in ACTION_TYPES]
    return _code_shares(counts, [f"action_type{a}_percent" for a in ACTION_TYPES], "action_type_nui")


def streaks() -> Stats:
    """Longest streak, latest streak of two days or more, population variance of streaks."""
    aggregates = {
        "run_max": "coalesce(max(run_days), 1)",
        "run_last": "coalesce(max_by(run_days, IF(run_days IS NULL, NULL, day)), 1)",
        "run_var": "coalesce(var_pop(run_days), 0d)",
    }
    return Stats(
        aggregates, {"max_lx_days": "bigint(run_max)", "last_lx_days": "bigint(run_last)", "lx_var": "run_var"}
    )


def offset_counts(intervals: Sequence[Interval] | None) -> Stats:
    """Rows exactly k days before the interval's last day; NULL when there are none."""
    ago = f"{last_day(intervals)} - day"
    return _same({f"ls_{k}": f"sum(IF({ago} = {k}, n, NULL))" for k in OFFSETS})


def trailing_counts(intervals: Sequence[Interval] | None) -> Stats:
    """Weighted rows in the last 3, 5 and 7 days, the last day included."""
    ago = f"{last_day(intervals)} - day"
    return Stats(
        {f"in_last_{d}": f"sum(IF({ago} BETWEEN 0 AND {d - 1}, n, NULL))" for d in TRAILING_WEIGHTS},
        {f"ls_day{d}": f"{weight}d * in_last_{d}" for d, weight in TRAILING_WEIGHTS.items()},
    )


def all_stats(intervals: Sequence[Interval]) -> Stats:
    """Every statistic, for the one aggregate of the feature plan."""
    return (
        day_stats()
        | recency(intervals)
        | gap_stats()
        | rank_stats()
        | volume_variance()
        | daily_profile()
        | page_shares()
        | action_shares()
        | streaks()
        | offset_counts(intervals)
        | trailing_counts(intervals)
    )


def aggregate_days(days: DataFrame, stats: Stats) -> DataFrame:
    """One row per (interval, user, part) with the aggregates alone."""
    return aggregate(days, GROUP, [f"{sql} AS {name}" for name, sql in stats.aggregates.items()])


def summarise(days: DataFrame, stats: Stats) -> DataFrame:
    """One row per (interval, user, part) with the outputs; the day table must be cut."""
    outputs = [f"{sql} AS {name}" for name, sql in stats.outputs.items()]
    return aggregate_days(days, stats).selectExpr(*GROUP, *outputs)


def summarise_windows(days: DataFrame, stats: Stats, tasks: int | None = None) -> DataFrame:
    """Like ``summarise``, for statistics that need the day windows."""
    return summarise(with_day_windows(days, tasks), stats)
