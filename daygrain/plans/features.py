"""The feature matrix: 175 columns per (interval, user), all intervals in one pass."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.functions.stats import aggregate, ratio
from daygrain.operators.day_stats import OFFSETS, TRAILING_WEIGHTS, aggregate_days, all_stats
from daygrain.operators.day_table import by_user, cut_days_into_parts, day_table, tasks_for, with_day_windows
from daygrain.operators.distincts import distinct_counts
from daygrain.operators.gaps import GAP_STATS, late_gap_stats
from daygrain.operators.intervals import INTERVALS, Interval, assign_intervals, last_day
from daygrain.operators.log_scalars import log_scalars
from daygrain.session import shared_dir, staged
from daygrain.sources.logs import ACTION_TYPES, LOGS, PAGES

KEYS = ["interval_id", "user_id"]
GAP_LOGS = ("create", "launch", "activity")
RANK_STATS = ("count", "max", "min", "mean", "median", "skew", "std", "last")

# Output column -> (log, statistic of day_stats) in catalogue order.
Catalogue = dict[str, tuple[str, str]]


def _day_stats(log: str) -> Catalogue:
    return {f"{log}_day_{s}": (log, s) for s in ("count", "max", "min", "mean", "last", "uni", "radio")}


def _size_and_recency(log: str) -> Catalogue:
    return {LOGS[log].recency: (log, "recency"), LOGS[log].size: (log, "count")}


def _gaps(log: str) -> Catalogue:
    return {f"{log}_day_{s}": (log, s) for s in GAP_STATS}


def _ranks(log: str) -> Catalogue:
    return {f"rank_{log}_day_{s}": (log, f"rank_{s}") for s in RANK_STATS}


def _streaks(log: str) -> Catalogue:
    return {f"{LOGS[log].streak}_{s}": (log, s) for s in ("max_lx_days", "last_lx_days", "lx_var")}


def _recent(log: str) -> Catalogue:
    return {f"ls_{k}_{LOGS[log].offset_word}_cout": (log, f"ls_{k}") for k in OFFSETS} | {
        f"ls_day{n}_{log}_cout": (log, f"ls_day{n}") for n in TRAILING_WEIGHTS
    }


def _volume(log: str) -> Catalogue:
    return {LOGS[log].volume: (log, "volume_var")}


def _activity_codes() -> Catalogue:
    names = [f"page_{p}" for p in PAGES] + [f"page{p}_percent" for p in PAGES]
    names += [f"action_type_{a}" for a in ACTION_TYPES] + [f"action_type{a}_percent" for a in ACTION_TYPES]
    profile = [f"day_{c}_count_{s}" for c in ("page", "action") for s in ("max", "min", "mean", "std")]
    return {name: ("activity", name) for name in names} | {f"act_{name}": ("activity", name) for name in profile}


def _code_kinds() -> Catalogue:
    return {f"user_id_{c}_nui": ("activity", f"{c}_nui") for c in ("action_type", "page")}


def day_table_catalogue() -> Catalogue:
    out: Catalogue = {}
    for log in GAP_LOGS:
        out |= _day_stats(log) | _size_and_recency(log) | _gaps(log) | _volume(log)
        out |= _ranks(log) | _streaks(log) | _recent(log)
    return out | _code_kinds() | _activity_codes() | _day_stats("register") | _streaks("register") | _recent("register")


def _derived(intervals: Sequence[Interval]) -> dict[str, str]:
    """SQL over the assembled row: distances to the log scalars, ratios, age of the registration."""
    shares = {
        f"user_id_{a}_nui_ratio": ratio(f"user_id_{a}_nui", "activity_day_count")
        for a in ("video", "author", "action_type", "page")
    }
    return {
        "create_register_day": "create_day_last - register_max",
        "create_register_day_min": "create_day_min - create_min",
        "create_register_day_mean": "create_day_mean - create_mean",
        "register_register_day": "register_day_last - register_max",
        "launch_register_day": "launch_day_last - register_max",
        "launch_register_day_mean": "launch_day_mean - launch_mean",
        "activity_register_day": "activity_day_last - register_max",
        "activity_register_day_min": "activity_day_min - activity_min",
        "activity_register_day_first": "activity_day_min - register_max",
        **shares,
        "register_days": f"bigint({last_day(intervals)} - register_day)",
    }


# Outputs that are distances to a scalar of the whole log.
OFFSETS_FROM_SCALARS = tuple(name for name, sql in _derived(INTERVALS).items() if " - " in sql and not name.endswith("days"))
RAW_REGISTER = ("register_day", "register_type", "device_type")
DISTINCTS = {"user_id_video_nui": "video_nui", "user_id_author_nui": "author_nui"}
# Output columns, log by log; the names in plain text are those of ``_derived``.
FEATURES: tuple[str, ...] = (
    *_day_stats("create"),
    "create_register_day", "create_register_day_min", "create_register_day_mean",
    *_size_and_recency("create"), *_gaps("create"), *_volume("create"), *_ranks("create"),
    *_streaks("create"), *_recent("create"),
    *RAW_REGISTER,
    *_day_stats("register"),
    "register_register_day",
    *_recent("register"), *_streaks("register"),
    *_day_stats("launch"),
    "launch_register_day", "launch_register_day_mean",
    *_size_and_recency("launch"), *_gaps("launch"), *_volume("launch"), *_ranks("launch"),
    *_streaks("launch"), *_recent("launch"),
    *_day_stats("activity"),
    "activity_register_day", "activity_register_day_min", "activity_register_day_first",
    *_size_and_recency("activity"),
    *DISTINCTS, *_code_kinds(),
    "user_id_video_nui_ratio", "user_id_author_nui_ratio",
    "user_id_action_type_nui_ratio", "user_id_page_nui_ratio",
    *_gaps("activity"), *_activity_codes(), *_volume("activity"), *_ranks("activity"),
    *_streaks("activity"), *_recent("activity"),
    "register_days",
)


def _unused() -> set[str]:
    """The 54 outputs that the model does not read."""
    names = {f"rank_{log}_day_{s}" for log in GAP_LOGS for s in RANK_STATS}
    names |= {f"ls_{k}_{spec.offset_word}_cout" for spec in LOGS.values() for k in (4, 5, 6)}
    names |= {f"action_type{a}_percent" for a in ACTION_TYPES}
    return names | {
        "register_day", "register_day_max", "register_day_min", "register_day_mean", "register_day_last",
        "register_day_uni", "register_day_radio", "launch_register_day_mean", "activity_day_uni",
        "activity_day_radio", "user_id_action_type_nui", "user_id_action_type_nui_ratio",
    }


MODEL_FEATURES: tuple[str, ...] = tuple(name for name in FEATURES if name not in _unused())


def _pivot_parts(sums: DataFrame, used: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per population member with the wanted (log, aggregate) pairs side by side.

    The rows are already hashed on (interval, user), so this adds no shuffle.
    """
    columns = [f"max(IF(part = '{log}', {name}, NULL)) AS {_side(log)}{name}" for log, name in used]
    columns.append("max(part = 'label') AS acted")
    return aggregate(sums, KEYS, [*columns, "max(part = 'population') AS member"]).where("member").drop("member")


def _side(log: str) -> str:
    return f"{log}__"


def feature_matrix(
    stacked: DataFrame,
    register: DataFrame,
    intervals: Sequence[Interval] = INTERVALS,
    pieces: int | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """``interval_id, user_id``, the 175 features and ``label`` (NULL where there is no label week).

    ``days`` is the day table of ``stacked`` if it is stored already (``staged_days``), else it is
    stored here; three readers then share one pass over the logs.

    Aggregates first, side by side, and only then the arithmetic over them: the wide
    projection is compiled in small methods, while the output of an aggregate is one
    method and would grow too large for the JIT compiler. The gaps of users whose days mix in
    file order, if there are any, come from their rows and are joined by key.
    """
    stats = all_stats(intervals)
    outputs, used = {}, set()
    for name, (log, stat) in day_table_catalogue().items():
        outputs[name], aggregates = stats.output_of(stat, _side(log))
        used |= {(log, a) for a in aggregates}

    table = staged_days(stacked) if days is None else days
    cut = cut_days_into_parts(table, intervals)
    tasks = tasks_for(cut)

    def beside(df: DataFrame) -> DataFrame:
        """Dealt like the users, which then stay where they are in the join."""
        return by_user(df, tasks) if tasks else df

    days = with_day_windows(cut, tasks)
    users = _pivot_parts(aggregate_days(days, stats), sorted(used))
    raw = assign_intervals(register.select("user_id", *RAW_REGISTER), "register_day", intervals)
    wide = (
        users.join(beside(distinct_counts(stacked, intervals)), KEYS, "left")
        .join(beside(raw), KEYS, "left")
        # one row per interval
        .join(F.broadcast(log_scalars(table, intervals)), "interval_id", "left")
    )
    late = late_gap_stats(stacked, table, intervals, pieces)
    if late is not None:
        wide = wide.join(_side_by_side(beside(late)), KEYS, "left")
        outputs |= {name: f"coalesce({outputs[name]}, late_{name})" for name in _late_gaps()}
    # a user with activity rows but only NULL videos has 0 distinct videos, not NULL
    outputs |= {
        name: f"IF(activity_day_count IS NULL, NULL, coalesce({source}, 0))" for name, source in DISTINCTS.items()
    }
    outputs |= {name: name for name in RAW_REGISTER}
    for name, sql in (_derived(intervals) | {name: outputs[name] for name in DISTINCTS}).items():
        outputs[name] = _inlined(sql, outputs)
    labelled = ", ".join(str(iv.interval_id) for iv in intervals if iv.label_begin is not None)
    label = f"IF(interval_id IN ({labelled or 'NULL'}), int(acted), NULL) AS label"
    return wide.selectExpr(*KEYS, *[f"{outputs[name]} AS {name}" for name in FEATURES], label)


def _late_gaps() -> Catalogue:
    return {f"{log}_day_{s}": (log, s) for log in GAP_LOGS for s in GAP_STATS}


def _side_by_side(late: DataFrame) -> DataFrame:
    """Gap statistics of the logs in one row per (interval, user), named ``late_`` and the output."""
    columns = [f"max(IF(part = '{log}', {s}, NULL)) AS late_{name}" for name, (log, s) in _late_gaps().items()]
    return aggregate(late, KEYS, columns)


def _inlined(sql: str, outputs: dict[str, str]) -> str:
    """SQL with the names of other outputs replaced by their SQL, so that one projection does all."""
    while names := set(re.findall(r"\w+", sql)) & set(outputs) - set(RAW_REGISTER):
        sql = re.sub(r"\w+", lambda m: f"({outputs[m[0]]})" if m[0] in names else m[0], sql)  # noqa: B023
    return sql


def write_matrix(matrix: DataFrame, path: str) -> DataFrame:
    """The matrix written by interval, and read back."""
    matrix.write.mode("overwrite").partitionBy("interval_id").parquet(path)
    return matrix.sparkSession.read.schema(matrix.schema).parquet(path)


def staged_days(stacked: DataFrame) -> DataFrame:
    """The day table written to a new place in the shared folder, and read back."""
    return staged(day_table(stacked), "days")


def staged_matrix(matrix: DataFrame) -> DataFrame:
    """The matrix written to a new place in the shared folder, and read back."""
    return write_matrix(matrix, f"{shared_dir(matrix.sparkSession)}/features-{uuid.uuid4().hex}")


def used_features(matrix: DataFrame) -> DataFrame:
    """Keys, the 121 columns the model reads, and the label."""
    return matrix.select(*KEYS, *MODEL_FEATURES, "label")
