import csv
import glob

import pytest
from daygrain.operators.intervals import INTERVALS, assign_intervals, cut
from daygrain.operators.labels import labels, population
from daygrain.sources.logs import (
    FILE_ORDER,
    LOGS,
    read_ids,
    read_log,
    stack_logs,
    write_raw_log,
    write_submission,
    write_table,
)
from pyspark.sql import functions as F

import helpers


def test_raw_log_keeps_file_order_across_splits(spark, tmp_path):
    days = [(i * 7919) % 30 + 1 for i in range(5000)]
    for name, part in (("a.txt", days[:3000]), ("b.txt", days[3000:])):
        (tmp_path / name).write_text("".join(f"{i % 50}\t{d}\n" for i, d in enumerate(part)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_log(spark, str(tmp_path), "create")
        assert rows.rdd.getNumPartitions() > 3
        got = [r.video_create_day for r in rows.orderBy("seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == days
    assert dict(rows.dtypes)["seq"] == FILE_ORDER


def test_reading_joins_and_shuffles_nothing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\t2\n")
    plan = read_log(spark, str(tmp_path), "create")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan


def test_file_order_of_many_small_files_and_odd_names(spark, tmp_path):
    """Files that share tasks, and splits of one file in several tasks."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        for n, name in enumerate(sorted(["a b.txt", "a%20c.txt", "a+d.txt", "é.txt", "z.txt", "y.txt", "x#1.txt"])):
            days = [(i * 7919 + n) % 30 + 1 for i in range(20 if n % 2 else 900)]
            (tmp_path / name).write_text("".join(f"{n}\t{d}\n" for d in days))
        rows = read_log(spark, str(tmp_path), "create")
        got = rows.orderBy("seq").collect()
        by_file = {}
        for r in got:
            by_file.setdefault(r.user_id, []).append(r.video_create_day)
        for n, days in by_file.items():
            assert days == [(i * 7919 + n) % 30 + 1 for i in range(20 if n % 2 else 900)]
        assert len(by_file) == 7 and [r.user_id for r in got] == sorted((r.user_id for r in got), key=list(by_file).index)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_numbers_and_file_order_stack(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\t2\n1\t3\n")
    launch = read_log(spark, str(tmp_path / "a.txt"), "launch")
    create = spark.createDataFrame([(1, 5, 70), (1, 6, 8)], "user_id long, video_create_day int, seq int")
    register = spark.createDataFrame([(1, 4, 0, 0)], LOGS["register"].schema)
    rows = stack_logs({"launch": launch, "create": create, "register": register})
    assert dict(rows.dtypes)["seq"] == FILE_ORDER
    assert [(r.log, r.day) for r in rows.orderBy("log", "seq").collect()] == [
        ("create", 6), ("create", 5), ("launch", 2), ("launch", 3), ("register", 4)
    ]
    assert dict(stack_logs({"create": create, "register": register}).dtypes)["seq"] == "bigint"


def test_csv_round_trip_and_id_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3, 4), (5, 6, None, 8)], LOGS["register"].schema)
    write_table(df, str(tmp_path / "r"))
    back = read_log(spark, str(tmp_path / "r"), "register", header=True, sep=",")
    assert sorted(back.drop("seq").collect()) == sorted(df.collect())
    ids = read_ids(spark, str(tmp_path / "r"), "register")
    assert "ReadSchema: struct<user_id:bigint>" in ids._jdf.queryExecution().toString()
    assert sorted(r.user_id for r in ids.collect()) == [1, 5]


def test_raw_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 0), (1, 2, None, 4, None, 1)], LOGS["activity"].schema)
    write_raw_log(df, str(tmp_path / "a"), "activity")
    assert sorted(map(str, read_log(spark, str(tmp_path / "a"), "activity").drop("seq").collect())) == sorted(
        map(str, df.collect())
    )


def test_submission_has_no_header(spark, tmp_path):
    write_submission(spark.createDataFrame([(7, 0.25)], "user_id long, result double"), str(tmp_path / "s"))
    lines = [row for f in glob.glob(str(tmp_path / "s" / "part-*")) for row in csv.reader(open(f))]
    assert lines == [["7", "0.25"]]


def test_log_without_row_order_is_refused(spark):
    with pytest.raises(ValueError, match="seq"):
        stack_logs({"launch": spark.createDataFrame([(1, 2)], LOGS["launch"].schema)})


def test_cut_and_assignment(spark):
    df = spark.range(1, 32).select(F.col("id").cast("int").alias("day"))
    assert cut(df, "day", 17, 23).count() == 7
    counts = {r.interval_id: r["count"] for r in assign_intervals(df, "day", INTERVALS).groupBy("interval_id").count().collect()}
    assert counts == {1: 16, 2: 16, 3: 16}


def test_label_ignores_registration_and_population_keeps_early_users(spark):
    logs = {
        "register": [{"user_id": u, "day": d, "register_type": 0, "device_type": 0} for u, d in ((1, 3), (2, 18), (3, 29))],
        "launch": [{"user_id": 1, "day": 17}, {"user_id": 9, "day": 17}], "create": [], "activity": [{"user_id": 2, "day": 24}],
    }
    stacked = helpers.stacked(spark, logs)
    members = {(r.interval_id, r.user_id) for r in population(stacked, INTERVALS).collect()}
    assert members == {(1, 1), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3)}
    got = {(r.interval_id, r.user_id): r.label for r in labels(stacked, INTERVALS).collect()}
    assert got == {(1, 1): 1, (2, 1): 0, (2, 2): 1}
