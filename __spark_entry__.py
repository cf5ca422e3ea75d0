
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from daygrain.operators import day_stats as stats
from daygrain.operators.day_table import cut_days, day_table, with_day_windows
from daygrain.operators.distincts import distinct_counts
from daygrain.operators.gaps import complete_gap_stats, day_gaps
from daygrain.operators.intervals import INTERVALS, assign_cuts, assign_intervals, cut, day_span
from daygrain.operators.interval_table import (
    assign,
    cut_days_by_table,
    feature_days,
    interval_table,
    labels_by_table,
    rolling_intervals,
)
from daygrain.operators.labels import active_ids, distinct_ids, labels, population
from daygrain.operators.log_scalars import log_scalars
from daygrain.operators.metrics import auc, log_loss
from daygrain.plans import features, model
from daygrain.session import shared_dir, staged
from daygrain.sources.events import ORDERS, log_from_events, logs_from_events
from daygrain.sources.logs import (
    LOGS,
    read_ids,
    read_log,
    stack_logs,
    write_raw_log,
    write_submission,
    write_table,
)
from fixtures import ensemble

try:
    import corpus_pipeline
    from daygrain.llm import queries as llm
except ModuleNotFoundError as gone:  # that folder may be taken out
    if gone.name not in ("corpus_pipeline", "daygrain.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE = features.day_table_catalogue()
OTHER_ORDERS = tuple(order for order in ORDERS if order != "time")
ROLLED = stats.day_stats() | stats.recency(None) | stats.offset_counts(None) | stats.trailing_counts(None)
ROWS = stats.Stats({"rows": "sum(n)"}, {"n": "rows"})


SPAN = day_span(INTERVALS)


def _stacked(spark: SparkSession, sf_dir: str, only: str | None = None, days: tuple[int, int] = SPAN) -> DataFrame:
    logs = {only: log_from_events(spark, sf_dir, only, days)} if only else logs_from_events(spark, sf_dir, days)
    return stack_logs(logs, days)


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 places, so that both engines hash alike."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _matrix(spark: SparkSession, sf_dir: str, order: str = "time") -> DataFrame:
    logs = logs_from_events(spark, sf_dir, SPAN, order)
    stacked = stack_logs(logs, SPAN)
    return features.feature_matrix(stacked, logs["register"], days=features.staged_days(stacked))


def _staged_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.staged_matrix(_matrix(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """The feature matrix of all three intervals at sf0.001."""
    return _matrix(spark, "/root/testdata/sf0.001")


def _log_queries() -> dict[str, tuple[str, stats.Stats, bool]]:
    """Statistics registered per log: query name -> (log, statistics, needs the day windows)."""
    out = {}
    for log in LOGS:
        out[f"day_stats_{log}"] = (log, stats.day_stats(), False)
        out[f"streak_{log}"] = (log, stats.streaks(), True)
        out[f"offset_counts_{log}"] = (log, stats.offset_counts(INTERVALS), False)
        out[f"trailing_weighted_{log}"] = (log, stats.trailing_counts(INTERVALS), False)
    for log in features.GAP_LOGS:
        out[f"recency_{log}"] = (log, stats.recency(INTERVALS), False)
        out[f"rank_stats_{log}"] = (log, stats.rank_stats(), True)
        out[f"daily_volume_var_{log}"] = (log, stats.volume_variance(), False)
    out["daily_count_profile"] = ("activity", stats.daily_profile(), False)
    out["page_pivot_share"] = ("activity", stats.page_shares(), False)
    out["action_pivot_share"] = ("activity", stats.action_shares(), False)
    return out


def _names(log: str, computed: stats.Stats) -> dict[str, str]:
    """Output column -> statistic, for the statistics that are computed."""
    return {name: stat for name, (part, stat) in CATALOGUE.items() if part == log and stat in computed.outputs}


def _log_query(log: str, computed: stats.Stats, windows: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        days = cut_days(day_table(_stacked(spark, sf_dir, log)), INTERVALS)
        summary = (stats.summarise_windows if windows else stats.summarise)(days, computed)
        named = [f"{stat} AS {name}" for name, stat in _names(log, computed).items()]
        return _rounded(summary.selectExpr(*features.KEYS, *named))

    return run


def _gap_stats(log: str, order: str = "time") -> Query:
    named = [f"{s} AS {name}" for name, (part, s) in CATALOGUE.items() if part == log and s in features.GAP_STATS]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = stack_logs({log: log_from_events(spark, sf_dir, log, SPAN, order)}, SPAN)
        return _rounded(complete_gap_stats(rows, INTERVALS).selectExpr(*features.KEYS, *named))

    return run


def _distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stacked = _stacked(spark, sf_dir, "activity")
    codes = ROWS | stats.page_shares() | stats.action_shares()
    by_code = stats.summarise(cut_days(day_table(stacked), INTERVALS), codes)
    joined = by_code.join(distinct_counts(stacked, INTERVALS), features.KEYS)
    nui = {f"user_id_{a}_nui": F.col(f"{a}_nui") for a in ("video", "author", "action_type", "page")}
    ratios = {f"{name}_ratio": col / F.col("n") for name, col in nui.items()}
    return _rounded(joined.select(*features.KEYS, *[c.alias(name) for name, c in (nui | ratios).items()]))


def _global_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_matrix(spark, sf_dir).select(*features.KEYS, *features.OFFSETS_FROM_SCALARS))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed score: activity rows n of the interval as n / (n + 5)."""
    stacked = _stacked(spark, sf_dir)
    days = cut_days(day_table(stacked), INTERVALS).where("part = 'activity'")
    rows = stats.summarise(days, ROWS).drop("part")
    n = F.coalesce("n", F.lit(0))
    return labels(stacked, INTERVALS).join(rows, features.KEYS, "left").withColumn("score", n / (n + F.lit(5.0)))


def _dense_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = with_day_windows(cut_days(day_table(_stacked(spark, sf_dir)), INTERVALS))
    return days.select("interval_id", "user_id", "part", "day", "day_rank", "n")


def _rolling(rows: DataFrame) -> DataFrame:
    """200 overlapping weeks over the days of the log."""
    return rolling_intervals(rows, oracle.ROLLING, width=7, label_width=3)


def _assigned_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stack_logs({"launch": log_from_events(spark, sf_dir, "launch")})
    return assign(rows, feature_days(_rolling(rows))).select("interval_id", "log", "user_id", "day", "seq")


def _stats_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = staged(day_table(stack_logs({"launch": log_from_events(spark, sf_dir, "launch")})), "days")
    return _rounded(stats.summarise(cut_days_by_table(days, _rolling(days)), ROLLED).drop("part"))


def _labels_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stack_logs(logs_from_events(spark, sf_dir))
    return labels_by_table(rows, _rolling(rows.where("log = 'launch'")))


def _text_scan(log: str, raw: bool) -> Query:
    """A whole log written as text to a stage folder and read back with its fixed schema."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_dir(spark)}/{log}-{uuid.uuid4().hex}"
        df = log_from_events(spark, sf_dir, log)
        if raw:
            write_raw_log(df, path, log)
        else:
            write_table(df.select(*LOGS[log].schema.names), path)
        return read_log(spark, path, log, header=not raw, sep="\t" if raw else ",").drop("seq")

    return run


def _id_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/launch-{uuid.uuid4().hex}"
    write_table(log_from_events(spark, sf_dir, "launch").select(*LOGS["launch"].schema.names), path)
    return read_ids(spark, path, "launch")


def _file_order_gaps(order: str) -> Query:
    """Gap statistics of the launch log in the order of a text file written by ``seq`` and read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_dir(spark)}/launch-{uuid.uuid4().hex}"
        write_raw_log(log_from_events(spark, sf_dir, "launch", order=order).orderBy("seq"), path, "launch")
        log = stack_logs({"launch": read_log(spark, path, "launch")}, SPAN)
        return _rounded(complete_gap_stats(log, INTERVALS).drop("part"))

    return run


def _submission_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of the fixed trees, written without a header and read back."""
    path = f"{shared_dir(spark)}/submission-{uuid.uuid4().hex}"
    write_submission(ensemble.submission(_matrix(spark, sf_dir)), path)
    return _rounded(spark.read.schema("user_id long, result double").csv(path))


def _train_val_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = features.used_features(_staged_matrix(spark, sf_dir))
    train, val = (used.where(F.col("interval_id") == i) for i in (1, 2))
    return _rounded(train.unionByName(val))


def queries() -> dict[str, Query]:
    rows = ("log", "user_id", "day", "seq")
    out: dict[str, Query] = {
        "tsv_scan_activity": _text_scan("activity", raw=True),
        "tsv_scan_create": _text_scan("create", raw=True),
        "tsv_scan_register": _text_scan("register", raw=True),
        "tsv_scan_launch": _text_scan("launch", raw=True),
        "file_order_gaps": _file_order_gaps("time"),
        "file_order_gaps_shuffled": _file_order_gaps("shuffled"),
        "csv_scan_register": _text_scan("register", raw=False),
        "id_scan_launch": _id_scan,
        "interval_cut": lambda s, d: cut(_stacked(s, d, days=(1, 16)), "day", 1, 16).select(*rows),
        "five_cuts": lambda s, d: assign_cuts(_stacked(s, d), "day", INTERVALS).select("interval_id", "cut", *rows),
        "interval_assign": lambda s, d: assign_intervals(_stacked(s, d), "day", INTERVALS).select("interval_id", *rows),
        "interval_assign_rolling": _assigned_rolling,
        "day_stats_rolling": _stats_rolling,
        "labels_rolling": _labels_rolling,
        "labels_by_table": lambda s, d: labels_by_table(_stacked(s, d), interval_table(s, INTERVALS)),
        "label_build": lambda s, d: labels(_stacked(s, d), INTERVALS),
        "score_population": lambda s, d: distinct_ids(log_from_events(s, d, "register")),
        "population_by_interval": lambda s, d: population(_stacked(s, d), INTERVALS),
        "active_ids_union": lambda s, d: distinct_ids(
            *[log_from_events(s, d, log) for log in features.GAP_LOGS]
        ),
        "label_week_active_ids": lambda s, d: active_ids(_stacked(s, d), INTERVALS),
        "log_scalars": lambda s, d: _rounded(log_scalars(day_table(_stacked(s, d)), INTERVALS)),
        "global_offsets": _global_offsets,
        "distinct_counts_activity": _distinct_counts,
        "day_gaps": lambda s, d: day_gaps(_stacked(s, d), INTERVALS),
        "dense_rank_days": _dense_rank,
        "auc_exact": lambda s, d: _rounded(auc(_scored(s, d), "score", "label", by=["interval_id"])),
        "log_loss": lambda s, d: _rounded(log_loss(_scored(s, d), "score", "label", by=["interval_id"])),
        "train_val_union": _train_val_union,
        "feature_matrix": lambda s, d: _rounded(_matrix(s, d)),
        "model_features": lambda s, d: _rounded(features.used_features(_matrix(s, d))),
    }
    for name, (log, computed, windows) in _log_queries().items():
        out[name] = _log_query(log, computed, windows)
    for log in features.GAP_LOGS:
        out[f"gap_stats_{log}"] = _gap_stats(log)
        for order in OTHER_ORDERS:
            out[f"gap_stats_{log}_{order}"] = _gap_stats(log, order)
    for order in OTHER_ORDERS:
        out[f"feature_matrix_{order}"] = lambda s, d, order=order: _rounded(_matrix(s, d, order))
    out["ensemble_round_auc"] = lambda s, d: _rounded(ensemble.round_auc(_matrix(s, d)))
    out["ensemble_choice"] = lambda s, d: _rounded(ensemble.choice(_staged_matrix(s, d)))
    out["ensemble_importance"] = lambda s, d: ensemble.importances(_matrix(s, d))
    out["ensemble_scores"] = lambda s, d: _rounded(ensemble.submission(_matrix(s, d)))
    out["submission_ids"] = _submission_ids
    out["gbt_train_eval"] = lambda s, d: model.train_and_evaluate(_staged_matrix(s, d))
    out["gbt_importance"] = lambda s, d: model.train_importances(_staged_matrix(s, d))
    out["gbt_submission"] = lambda s, d: model.refit_and_score(_staged_matrix(s, d))
    out["gbt_score_agreement"] = lambda s, d: model.score_agreement(_staged_matrix(s, d))
    out["gbt_importance_agreement"] = lambda s, d: model.importance_agreement(_staged_matrix(s, d))
    if llm:
        out |= llm.QUERIES | {"pipeline": llm.on_workers(corpus_pipeline.run)}
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query; the GBT queries have none (rows-only check)."""
    out = oracle.simple()
    for name, (log, computed, _) in _log_queries().items():
        out[name] = oracle.log_stats(log, _names(log, computed))
    for log in features.GAP_LOGS:
        named = {name: s for name, (part, s) in CATALOGUE.items() if part == log and s in features.GAP_STATS}
        out[f"gap_stats_{log}"] = oracle.log_stats(log, named)
        for order in OTHER_ORDERS:
            out[f"gap_stats_{log}_{order}"] = oracle.in_order(out[f"gap_stats_{log}"], ORDERS[order])
    out["labels_by_table"] = out["label_build"]
    out["day_stats_rolling"] = oracle.rolling(oracle.log_stats("launch", {s: s for s in ROLLED.outputs}))
    out["file_order_gaps"] = oracle.log_stats("launch", {s: s for s in features.GAP_STATS})
    out["file_order_gaps_shuffled"] = oracle.in_order(out["file_order_gaps"], ORDERS["shuffled"])
    out["gbt_score_agreement"] = oracle.agreement("SELECT user_id FROM pop WHERE interval_id = 3")
    out["gbt_importance_agreement"] = oracle.agreement(
        " UNION ALL ".join(f"SELECT '{name}' AS feature" for name in model.INPUTS)
    )
    out |= oracle.ensemble(CATALOGUE, ensemble.TREES, ensemble.PATIENCE, ensemble.FEATURES)
    out["feature_matrix"] = oracle.matrix(CATALOGUE)
    for order in OTHER_ORDERS:
        out[f"feature_matrix_{order}"] = oracle.in_order(out["feature_matrix"], ORDERS[order])
    out["model_features"] = oracle.model_columns(CATALOGUE)
    out["train_val_union"] = oracle.model_columns(CATALOGUE, " WHERE interval_id < 3")
    if llm:
        out |= llm.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
