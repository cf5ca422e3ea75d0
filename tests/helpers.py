"""Small logs for tests: row dicts in file order, and their DataFrames."""

from __future__ import annotations

import math
import random

from daygrain.operators.intervals import INTERVALS, day_span
from daygrain.sources.logs import LOGS, stack_logs
from pyspark.sql import types as T


def random_logs(seed, users=25, rows=400, hot_share=0.35, in_order=False):
    """Logs in a random (or time) order; user 0 holds a third of the rows, ids >= users are unregistered."""
    rng = random.Random(seed)
    logs = {log: [] for log in LOGS}
    for user in range(users):
        logs["register"].append({"user_id": user, "day": rng.randint(1, 30),
                                 "register_type": rng.randrange(4), "device_type": rng.randrange(11)})
    for log in ("create", "launch", "activity"):
        days = [rng.randint(1, 31) for _ in range(rows)]
        for day in sorted(days) if in_order else days:
            user = 0 if rng.random() < hot_share else rng.randrange(1, users + 5)
            row = {"user_id": user, "day": day}
            if log == "activity":
                row |= {
                    "page": rng.choice([0, 1, 2, 3, 4, None]), "action_type": rng.choice([0, 1, 2, 3, 4, 5, None]),
                    "video_id": rng.choice([None, *range(30)]), "author_id": rng.choice([None, *range(7)]),
                }
            logs[log].append(row)
    return logs


def frames(spark, logs):
    """DataFrames of the logs, ``seq`` being the position in the list."""
    out = {}
    for log, rows in logs.items():
        spec = LOGS[log]
        fields = list(spec.schema.fields)
        if log != "register":
            fields.append(T.StructField("seq", T.LongType()))
        data = []
        for seq, row in enumerate(rows):
            values = row | {spec.day: row["day"], "seq": seq * 3}
            data.append(tuple(values.get(f.name) for f in fields))
        out[log] = spark.createDataFrame(data, T.StructType(fields)).repartition(3)
    return out


def stacked(spark, logs):
    return stack_logs(frames(spark, logs), day_span(INTERVALS))


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
