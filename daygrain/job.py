"""The whole job: ``spark-submit --py-files daygrain.zip daygrain/job.py INPUT OUTPUT``.

Reads the four raw logs (header-less, tab-separated) under INPUT, once, and writes under
OUTPUT ``logs`` and ``features`` (Parquet, by day and by interval), ``metrics`` and
``importances`` (CSV with header) and ``submission`` (``user_id,result`` lines).
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from daygrain.operators.intervals import INTERVALS, day_span
from daygrain.plans import model
from daygrain.plans.features import feature_matrix, staged_days, write_matrix
from daygrain.sources.logs import LOGS, RAW_FILES, read_log, stack_logs, write_submission, write_table


def write_by_day(rows: DataFrame, day: str, path: str) -> DataFrame:
    """``rows`` as Parquet in a folder per day, and read back.

    The rows are first brought together by day: Spark's rebalance cuts a day with more rows than
    a task should write (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) into several
    tasks and joins small days in one, so the number of files follows the size of the days and not the
    number of splits that were read.
    """
    rows.hint("rebalance", day).write.mode("overwrite").partitionBy(day).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(*rows.columns)


def ingest(spark: SparkSession, source: str, target: str) -> dict[str, DataFrame]:
    """The raw logs as Parquet with their file order, by day."""
    return {
        log: write_by_day(read_log(spark, f"{source}/{RAW_FILES[log]}", log), spec.day, f"{target}/{log}")
        for log, spec in LOGS.items()
    }


def run(spark: SparkSession, source: str, target: str, rounds: int = model.ROUNDS) -> None:
    logs = ingest(spark, source, f"{target}/logs")
    stacked = stack_logs(logs, day_span(INTERVALS))
    matrix = feature_matrix(stacked, logs["register"], days=staged_days(stacked))
    matrix = write_matrix(matrix, f"{target}/features")

    assembled = model.assemble(matrix)
    trained = model.train(assembled, rounds)
    write_table(model.evaluate(trained, assembled), f"{target}/metrics")
    write_table(model.importances(trained, spark), f"{target}/importances")
    write_submission(model.refit_and_score(matrix, rounds), f"{target}/submission")


if __name__ == "__main__":
    run(SparkSession.builder.appName("daygrain").getOrCreate(), *sys.argv[1:3])
