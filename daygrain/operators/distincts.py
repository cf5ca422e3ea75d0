"""Distinct videos and authors per user: attributes without a small domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from daygrain.functions.stats import aggregate
from daygrain.operators.intervals import Interval

# Column of the activity log -> name of its distinct count.
ATTRIBUTES = {"video_id": "video_nui", "author_id": "author_nui"}


def distinct_counts(stacked: DataFrame, intervals: Sequence[Interval]) -> DataFrame:
    """``interval_id, user_id, video_nui, author_nui`` of the activity log.

    The heavy shuffle carries one row per (user, attribute, value) and task, with a flag
    per interval instead of one copy per interval. It hashes on the value too, so a
    heavy user's values spread over all tasks.
    """
    pairs = ", ".join(f"'{name}', {name}" for name in ATTRIBUTES)
    values = (
        stacked.where("log = 'activity'")
        .selectExpr("user_id", "day", f"stack({len(ATTRIBUTES)}, {pairs}) AS (attribute, value)")
        .where("value IS NOT NULL")
    )
    flags = [f"max(day BETWEEN {iv.begin} AND {iv.end}) AS in_{iv.interval_id}" for iv in intervals]
    distinct_values = aggregate(values, ("user_id", "attribute", "value"), flags)
    seen_in = ", ".join(f"IF(in_{iv.interval_id}, {iv.interval_id}, NULL)" for iv in intervals)
    return aggregate(
        distinct_values.selectExpr(f"explode(array_compact(array({seen_in}))) AS interval_id", "user_id", "attribute"),
        ("interval_id", "user_id"),
        [f"count_if(attribute = '{name}') AS {out}" for name, out in ATTRIBUTES.items()],
    )
