"""Plans that must hold at scale: pushed filters, pruned scans, few shuffles."""

import re

import helpers
import pytest
from daygrain import job
from daygrain.operators.day_table import cut_days_into_parts, day_table, tasks_for
from daygrain.operators.gaps import complete_gap_stats, out_of_order_users, row_gap_stats, split_summaries
from daygrain.operators.intervals import INTERVALS, day_span
from daygrain.plans import features
from daygrain.plans.features import feature_matrix, staged_days
from daygrain.sources.events import logs_from_events
from daygrain.sources.logs import read_log, stack_logs


@pytest.fixture(scope="module")
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_event_scan_is_pruned_and_bounded(spark):
    logs = logs_from_events(spark, "/root/testdata/sf0.001", (1, 16))
    plan = formatted(logs["launch"])
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,.*LessThan\(ts,", plan)
    assert re.search(r"PushedFilters: \[.*EqualTo\(event_type,view\)", plan)
    assert "2024-01-17" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_feature_plan_shuffles(spark, no_broadcast):
    logs = helpers.frames(spark, helpers.random_logs(1, users=3, rows=20))
    stacked = stack_logs(logs, day_span(INTERVALS))
    plan = plan_of(feature_matrix(stacked, logs["register"], days=staged_days(stacked)))
    # windows, distinct values, distinct counts, raw register, scalars (per day, per interval)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 6
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "Exchange SinglePartition" not in plan


def test_feature_tasks_follow_the_rows(spark, no_broadcast, monkeypatch):
    """Many rows are dealt over as many tasks as they need, and the joins leave them there."""
    logs = helpers.frames(spark, helpers.random_logs(1, users=20, rows=200))
    stacked = stack_logs(logs, day_span(INTERVALS))
    days = staged_days(stacked)
    cut = cut_days_into_parts(days, INTERVALS)
    assert tasks_for(cut) is None and tasks_for(cut, 10) == -(-cut.count() // 10) > 20
    whole = feature_matrix(stacked, logs["register"], days=days)
    monkeypatch.setattr(features, "tasks_for", lambda df: tasks_for(df, 10))
    dealt = feature_matrix(stacked, logs["register"], days=days)
    tasks = str(tasks_for(cut, 10))
    wide = [line for line in plan_of(dealt).splitlines() if "Exchange hashpartitioning(interval_id" in line]
    # windows, late gaps, distinct counts and registrations; no sorted or aggregated row of features
    assert sum(f", {tasks}), REPARTITION_BY_NUM" in line for line in wide) == 4
    assert dealt.rdd.getNumPartitions() == int(tasks)
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()


def test_interval_cut_reads_its_own_days(spark):
    import __spark_entry__ as contract

    plan = formatted(contract.queries()["interval_cut"](spark, "/root/testdata/sf0.001"))
    assert "2024-01-17" in plan and "2024-01-31" not in plan


def test_gaps_of_mixed_days_need_no_range_sort_of_rows(spark, no_broadcast, tmp_path):
    """A log in a scrambled order: summaries of its splits are folded, and rows stay where they are read."""
    rows = "".join(f"{i * 7 % 5}\t{i * 7919 % 30 + 1}\n" for i in range(4000))
    (tmp_path / "log.txt").write_text(rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        log = stack_logs({"launch": read_log(spark, str(tmp_path / "log.txt"), "launch")})
        assert not out_of_order_users(day_table(log)).isEmpty()
        summaries = split_summaries(log, INTERVALS)
        assert "Exchange" not in plan_of(summaries)
        assert summaries.count() <= 5 * 3 * log.rdd.getNumPartitions() < 4000 / 5
        plan = plan_of(complete_gap_stats(log, INTERVALS))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "rangepartitioning" not in plan and "FileScan csv" not in plan


def test_row_gap_plan_spreads_heavy_users(spark, no_broadcast):
    stacked = helpers.stacked(spark, helpers.random_logs(1, users=3, rows=20))
    plan = plan_of(row_gap_stats(stacked, INTERVALS))
    assert "rangepartitioning" in plan and "NestedLoop" not in plan
    # rows are hashed with their piece, never on the user alone
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "piece" in line or "Aggregate" not in line


def test_job_parses_each_raw_log_once(spark, tmp_path):
    from daygrain.sources.logs import LOGS, RAW_FILES, write_raw_log

    for log, df in logs_from_events(spark, "/root/testdata/sf0.001").items():
        write_raw_log(df, str(tmp_path / "in" / RAW_FILES[log]), log)
    logs = job.ingest(spark, str(tmp_path / "in"), str(tmp_path / "logs"))
    plan = plan_of(feature_matrix(stack_logs(logs, day_span(INTERVALS)), logs["register"]))
    assert "FileScan csv" not in plan and "FileScan parquet" in plan
    assert set(logs) == set(LOGS)
