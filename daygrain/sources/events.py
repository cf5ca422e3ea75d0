"""Map a generic ``events`` table to the four logs, every row of it.

Day 1 is ``ORIGIN``. An event belongs to one of ten users derived from its ``user_id``, so
that some users act in a label week and others don't; each gets a registration day from
the id.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from daygrain.sources.logs import LOGS

# The first day of the events table, and the event types behind each log.
ORIGIN = datetime.date(2024, 1, 1)
EVENT_TYPES = {"create": ("purchase",), "launch": ("view",), "activity": ("click", "error", "signup")}

_USER = "user_id * 100 + event_id % 10"
# File orders that can be asked for: by time, against it, and scrambled (a permutation of ids below the prime).
ORDERS = {"time": "event_id", "reversed": "-event_id", "shuffled": "(event_id * 7919) % 1000003"}
_COLUMNS = {
    "create": "user_id, day AS video_create_day, event_id AS seq",
    "launch": "user_id, day AS app_launch_day, event_id AS seq",
    "activity": """user_id, day AS user_activity_day, k % 5 AS page, bigint(k) AS video_id,
        bigint(k % 17) AS author_id, k % 6 AS action_type, event_id AS seq""",
}


def log_from_events(
    spark: SparkSession, sf_dir: str, log: str, days: tuple[int, int] | None = None, order: str = "time"
) -> DataFrame:
    """One log, derived from ``{sf_dir}/events.parquet``; only the given days, if any (not of ``register``).

    ``order`` names the order of the rows in the file (``ORDERS``).
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if log == "register":
        return events.selectExpr(f"{_USER} AS user_id").distinct().selectExpr(
            "user_id",
            "int(1 + (user_id * 5) % 28) AS register_day",
            "int(user_id % 4) AS register_type",
            "int(user_id % 11) AS device_type",
        )
    types = ", ".join(f"'{t}'" for t in EVENT_TYPES[log])
    columns = _COLUMNS[log].replace("event_id AS seq", f"{ORDERS[order]} AS seq")
    bounds = ""
    if days:
        start, end = (ORIGIN + datetime.timedelta(days=d) for d in (days[0] - 1, days[1]))
        # Plain bounds on the stored ts reach the Parquet scan; the derived day would not.
        bounds = f" AND ts >= TIMESTAMP_NTZ'{start}' AND ts < TIMESTAMP_NTZ'{end}'"
    sql = f"""
        SELECT {columns}
        FROM (
          SELECT event_id, {_USER} AS user_id, datediff(date(ts), DATE'{ORIGIN}') + 1 AS day,
            int(get_json_object(props, '$.k')) AS k
          FROM {{events}}
          WHERE event_type IN ({types}){bounds}
        )
    """
    return spark.sql(sql, events=events)


def logs_from_events(
    spark: SparkSession, sf_dir: str, days: tuple[int, int] | None = None, order: str = "time"
) -> dict[str, DataFrame]:
    """All four logs."""
    return {log: log_from_events(spark, sf_dir, log, days, order) for log in LOGS}
