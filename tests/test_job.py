import csv
import glob

import pytest
from daygrain import job
from daygrain.sources.events import logs_from_events
from daygrain.sources.logs import RAW_FILES, write_raw_log

SF_DIR = "/root/testdata/sf0.01"


def lines(path):
    return [row for f in sorted(glob.glob(f"{path}/part-*")) for row in csv.reader(open(f))]


def test_whole_job_from_raw_files(spark, tmp_path):
    for log, df in logs_from_events(spark, SF_DIR).items():
        ordered = df.orderBy("seq") if "seq" in df.columns else df
        write_raw_log(ordered.coalesce(1), str(tmp_path / "in" / RAW_FILES[log]), log)
    job.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), rounds=2)

    counts = spark.read.parquet(str(tmp_path / "out" / "features")).groupBy("interval_id").count().collect()
    assert {r.interval_id: r["count"] for r in counts} == {1: 857, 2: 1242, 3: 1498}
    header, row = lines(tmp_path / "out" / "metrics")
    assert header == ["best_round", "auc", "log_loss"] and 0 <= float(row[1]) <= 1
    importances = lines(tmp_path / "out" / "importances")
    assert importances[0] == ["feature", "important", "gain"] and len(importances) == 126
    scores = lines(tmp_path / "out" / "submission")
    assert len(scores) == len({user for user, _ in scores}) == 1498
    assert all(0 < float(p) < 1 for _, p in scores)


@pytest.mark.parametrize("splits", [3, 60])
def test_files_per_day_do_not_grow_with_splits(spark, tmp_path, splits):
    rows = spark.range(30_000, numPartitions=splits).selectExpr("id AS user_id", "int(1 + id % 10) AS app_launch_day", "id AS seq")
    back = job.write_by_day(rows, "app_launch_day", str(tmp_path / "log"))
    files = [len(list(day.glob("*.parquet"))) for day in (tmp_path / "log").glob("app_launch_day=*")]
    assert len(files) == 10 and max(files) <= 2
    assert back.count() == 30_000 and back.columns == rows.columns
    assert back.exceptAll(rows).isEmpty()


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    """A third of all rows on one day: its size, not its being one key, sets its files."""
    rows = spark.range(300_000, numPartitions=8).selectExpr(
        "id AS user_id", "IF(id % 3 = 0, 1, int(2 + id % 20)) AS app_launch_day", "xxhash64(id) AS seq"
    )
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.shuffle.partitions": "64"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        job.write_by_day(rows, "app_launch_day", str(tmp_path / "log"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "log").glob("app_launch_day=*")}
    assert files.pop("app_launch_day=1") >= 4
    # a day that is hashed beside the large one shares its tasks
    assert sorted(files.values())[len(files) // 2] <= 2
