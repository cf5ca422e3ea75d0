"""The four logs: schemas, readers, writers, and the stacked form used by every plan.

File order carries meaning ("last" row, gap to the previous row), so each log but
``register`` needs a ``seq`` column that states it: a whole number, or the struct that
``read_log`` makes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class LogSpec:
    """How one log names its day, and the words its output columns are built from."""

    log: str
    day: str
    columns: tuple[tuple[str, T.DataType], ...]
    streak: str
    offset_word: str
    size: str | None = None
    recency: str | None = None
    volume: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in self.columns])


# Raw column order of the header-less files, and the spellings of the
# output columns ("greister" included).
LOGS: dict[str, LogSpec] = {
    "create": LogSpec(
        "create", "video_create_day",
        (("user_id", T.LongType()), ("video_create_day", T.IntegerType())),
        streak="cre", offset_word="create",
        size="video_count_sum", recency="last_video_time", volume="video_day_sum_var",
    ),
    "register": LogSpec(
        "register", "register_day",
        (("user_id", T.LongType()), ("register_day", T.IntegerType()),
         ("register_type", T.IntegerType()), ("device_type", T.IntegerType())),
        streak="reg", offset_word="greister",
    ),
    "launch": LogSpec(
        "launch", "app_launch_day",
        (("user_id", T.LongType()), ("app_launch_day", T.IntegerType())),
        streak="lau", offset_word="launch",
        size="login_count_sum", recency="last_login_time", volume="lau_day_sum_var",
    ),
    "activity": LogSpec(
        "activity", "user_activity_day",
        (("user_id", T.LongType()), ("user_activity_day", T.IntegerType()), ("page", T.IntegerType()),
         ("video_id", T.LongType()), ("author_id", T.LongType()), ("action_type", T.IntegerType())),
        streak="act", offset_word="activity",
        size="act_count_sum", recency="last_act_time", volume="act_day_sum_var",
    ),
}

# Names of the raw files.
RAW_FILES = {
    "create": "video_create_log.txt",
    "register": "user_register_log.txt",
    "launch": "app_launch_log.txt",
    "activity": "user_activity_log.txt",
}

# The closed domains of the two activity codes.
PAGES = (0, 1, 2, 3, 4)
ACTION_TYPES = (0, 1, 2, 3, 4, 5)

# The part of monotonically_increasing_id that numbers the rows of a task.
_ROW_IN_TASK = (1 << 33) - 1
# The order of a row in text files: its file, where its split begins, and its place in the task that reads the split.
FILE_ORDER = "struct<file:string,start:bigint,row:bigint>"


def read_log(spark: SparkSession, path: str, log: str, *, header: bool = False, sep: str = "\t") -> DataFrame:
    """Read one log from text with its fixed schema, adding ``seq``, the file order as ``FILE_ORDER``.

    Structs compare field by field, files by their path. A task reads a split from its first row
    to its last, whatever else it reads, so the row number in the task orders the rows of a
    split. Nothing is joined and no task sees more than its own splits.
    """
    rows = spark.read.schema(LOGS[log].schema).option("header", header).option("sep", sep).csv(path)
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_TASK))
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        in_task.alias("row"),
    )
    return rows.select("*", order.cast(FILE_ORDER).alias("seq"))


def read_ids(spark: SparkSession, path: str, log: str, *, header: bool = True, sep: str = ",") -> DataFrame:
    """Only the ``user_id`` column of a log; the CSV scan is pruned to it."""
    return spark.read.schema(LOGS[log].schema).option("header", header).option("sep", sep).csv(path).select("user_id")


def write_table(df: DataFrame, path: str) -> None:
    """Write a table as CSV with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_raw_log(df: DataFrame, path: str, log: str) -> None:
    """Write a log in its raw form: header-less, tab-separated, fixed column order."""
    df.select(*LOGS[log].schema.names).write.mode("overwrite").option("sep", "\t").csv(path)


def write_submission(scores: DataFrame, path: str) -> None:
    """Write ``user_id,result`` lines without a header."""
    scores.select("user_id", "result").write.mode("overwrite").option("header", False).csv(path)


# Columns of the stacked form that only some logs have, with their types.
_OPTIONAL = {"page": "int", "video_id": "bigint", "author_id": "bigint", "action_type": "int"}
_DOMAINS = {"page": PAGES, "action_type": ACTION_TYPES}


def _checked(name: str) -> str:
    """SQL for a code that raises on a value outside the code's domain."""
    domain = ", ".join(map(str, _DOMAINS[name]))
    known = f"{name} IS NULL OR {name} IN ({domain})"
    return f"IF({known}, int({name}), int(raise_error('unknown {name}: ' || {name}))) AS {name}"


def stack_logs(logs: Mapping[str, DataFrame], days: tuple[int, int] | None = None) -> DataFrame:
    """One row per log row: ``log, user_id, day, seq, page, video_id, author_id, action_type``.

    ``days`` bounds the days kept from every log but ``register``, whose earlier rows
    still decide who belongs to a population. Rows without a user are dropped: no
    per-user operator keeps them. A page or action type outside its domain raises an error
    in the job. A register log without ``seq`` is ordered by its day. If any log has the
    struct as its order, numbers become one without a file.
    """
    by_file = any("seq" in df.columns and isinstance(df.schema["seq"].dataType, T.StructType) for df in logs.values())
    stacked = None
    for log, df in logs.items():
        spec = LOGS[log]
        if "seq" not in df.columns and log != "register":
            raise ValueError(f"the {log} log needs a seq column that states its row order")
        seq = "seq" if "seq" in df.columns else spec.day
        if not by_file:
            seq = f"bigint({seq})"
        elif "seq" not in df.columns or not isinstance(df.schema["seq"].dataType, T.StructType):
            seq = f"named_struct('file', '', 'start', 0L, 'row', bigint({seq}))"
        optional = [f"{kind}({name if name in df.columns else 'NULL'}) AS {name}" for name, kind in _OPTIONAL.items()]
        # an unknown code has no place among the outputs: better no result than a wrong one
        optional = [_checked(name) if name in _DOMAINS and name in df.columns else sql for name, sql in zip(_OPTIONAL, optional)]
        in_days = f" AND {spec.day} BETWEEN {days[0]} AND {days[1]}" if days and log != "register" else ""
        rows = df.where(f"user_id IS NOT NULL{in_days}").selectExpr(
            f"'{log}' AS log", "bigint(user_id) AS user_id", f"int({spec.day}) AS day", f"{seq} AS seq", *optional
        )
        stacked = rows if stacked is None else stacked.union(rows)
    if stacked is None:
        raise ValueError("no logs given")
    return stacked
