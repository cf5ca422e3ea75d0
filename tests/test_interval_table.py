"""Intervals from a table against the literal ones and against plain loops."""

import re

import helpers
import pytest
from daygrain.operators import day_stats as stats
from daygrain.operators import interval_table as it
from daygrain.operators.day_table import cut_days, day_table
from daygrain.operators.intervals import INTERVALS, assign_intervals
from daygrain.operators.labels import labels


@pytest.fixture(scope="module")
def logs():
    return helpers.random_logs(21, users=30, rows=300)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("most", [it.MOST_BROADCAST, 0])
def test_assignment_equals_the_literal_one(spark, logs, most):
    stacked = helpers.stacked(spark, logs)
    table = it.interval_table(spark, INTERVALS)
    got = it.assign(stacked, it.feature_days(table), most).select("interval_id", *stacked.columns)
    assert rows(got) == rows(assign_intervals(stacked, "day", INTERVALS).select("interval_id", *stacked.columns))


def test_labels_equal_the_literal_ones(spark, logs):
    stacked = helpers.stacked(spark, logs)
    assert rows(it.labels_by_table(stacked, it.interval_table(spark, INTERVALS))) == rows(labels(stacked, INTERVALS))


def test_labels_of_repeated_and_unbounded_intervals(spark, logs):
    """Rows of one id are one interval with all their label weeks; without an end a week has no days."""
    table = [(1, 1, 9, 10, 12, 9), (1, 2, 9, 20, 21, 14), (2, 1, 9, 8, 6, None), (2, 1, 9, 15, None, 3), (None, 1, 9, 5, 30, 4), (4, 1, 9, None, 30, 9)]
    got = it.labels_by_table(helpers.stacked(spark, logs), spark.createDataFrame(table, it.COLUMNS))
    first, active = {}, {}
    for log in logs:
        for r in logs[log]:
            if r["day"] <= 30 and log == "register":
                first[r["user_id"]] = min(r["day"], first.get(r["user_id"], 99))
            elif r["day"] <= 30:
                active.setdefault(r["user_id"], set()).add(r["day"])
    want = {}
    for i, _, _, begin, end, by in table:
        for user, day in first.items():
            if begin is not None and (by is None or day <= by):
                want.setdefault((i, user), 0)
    for i, _, _, begin, end, _ in table:
        for user, days in active.items():
            if (i, user) in want and end is not None and any(begin <= d <= end for d in days):
                want[i, user] = 1
    assert sorted(map(str, got.collect())) == sorted(f"Row(interval_id={i}, user_id={u}, label={x})" for (i, u), x in want.items())
    assert set(want.values()) == {0, 1}


def test_rows_of_users_and_intervals_are_not_shuffled(spark, logs):
    stacked = helpers.stacked(spark, logs)
    table = it.rolling_intervals(stacked.where("log = 'launch'"), 200, width=7, label_width=3)
    plan = it.labels_by_table(stacked, table)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(hashpartitioning|keys=)[(\[]interval_id#\d+, user_id", plan)
    # the join with the intervals is the last step
    assert plan.count("BroadcastHashJoin") == 1 and plan.index("BroadcastHashJoin") < plan.index("Exchange")


def test_statistics_equal_the_literal_ones(spark, logs):
    days = day_table(helpers.stacked(spark, logs))
    both = []
    for intervals, cut in ((INTERVALS, cut_days(days, INTERVALS)), (None, it.cut_days_by_table(days, it.interval_table(spark, INTERVALS)))):
        computed = stats.recency(intervals) | stats.offset_counts(intervals) | stats.trailing_counts(intervals)
        both.append(rows(stats.summarise(cut, computed)))
    assert both[0] == both[1] and both[0]


def test_two_hundred_rolling_intervals(spark, logs):
    stacked = helpers.stacked(spark, logs)
    launch = stacked.where("log = 'launch'")
    table = it.rolling_intervals(launch, 200, width=7, label_width=3).collect()
    days = [r["day"] for r in logs["launch"]]
    first, last = min(days), max(min(d, 30) for d in days)
    begins = [r.begin for r in table]
    assert len(table) == 200 and begins == sorted(begins) and begins[0] == first and begins[-1] <= last - 6
    assert all((r.end, r.label_begin, r.label_end, r.registered_by) == (r.begin + 6, r.begin + 7, r.begin + 9, r.begin + 6) for r in table)
    frame = spark.createDataFrame(table)
    got = it.assign(launch, it.feature_days(frame)).groupBy("interval_id").count().collect()
    assert {r.interval_id: r["count"] for r in got} == {
        r.interval_id: n for r in table if (n := sum(r.begin <= d <= r.end for d in days if d <= 30))
    }
    plan = it.assign(launch, it.feature_days(frame))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "inline" not in plan


def test_bounds_and_empty_tables(spark):
    register = spark.createDataFrame([(5,), (9,)], "day int")
    table = spark.createDataFrame([(1, 1, 3, None, None, None), (2, 4, 3, 8, 9, 6), (3, 1, 2, 5, 4, 2)], it.COLUMNS)
    found = it.population_days(table, register).groupBy("interval_id").count().collect()
    assert {r.interval_id: r["count"] for r in found} == {1: 5, 2: 2}
    assert {r.interval_id for r in it.feature_days(table).collect()} == {1, 3}
    assert {r.interval_id for r in it.label_days(table).collect()} == {2}
    assert it.population_days(table, register.where("false")).isEmpty()
    assert it.rolling_intervals(register.where("false"), 5, 7, 3).isEmpty()
    assert it.assign(register, it.feature_days(table.where("false"))).isEmpty()
