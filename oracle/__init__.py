"""DuckDB SQL that defines every registered query from the raw tables, row by row.

Written apart from the library: it works on single log rows (window functions over
rows, islands over rows), not on the day table, so the two check each other.
"""

from __future__ import annotations

from daygrain.plans.features import FEATURES, MODEL_FEATURES

# The logs derived from events, the intervals, and each log row once per interval.
BASE = """
ev AS (
  SELECT event_id, user_id * 100 + event_id % 10 AS user_id, event_type, ts,
         CAST(date_diff('day', date '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS day,
         CAST(1 + ((user_id * 100 + event_id % 10) * 5) % 28 AS INTEGER) AS reg_day,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k
  FROM events),
register AS (
  SELECT DISTINCT user_id, reg_day AS day, CAST(user_id % 4 AS INTEGER) AS register_type,
         CAST(user_id % 11 AS INTEGER) AS device_type FROM ev),
logs AS (
  SELECT CASE event_type WHEN 'view' THEN 'launch' WHEN 'purchase' THEN 'create' ELSE 'activity' END AS part,
         user_id, day, event_id AS seq,
         CASE WHEN event_type NOT IN ('view', 'purchase') THEN k % 5 END AS page,
         CASE WHEN event_type NOT IN ('view', 'purchase') THEN k % 6 END AS action_type,
         CASE WHEN event_type NOT IN ('view', 'purchase') THEN k END AS video_id,
         CASE WHEN event_type NOT IN ('view', 'purchase') THEN k % 17 END AS author_id
  FROM ev WHERE event_type IN ('view', 'purchase', 'click', 'error', 'signup')
  UNION ALL SELECT 'register', user_id, day, day, NULL, NULL, NULL, NULL FROM register),
iv(interval_id, b, e, lb, le, bound) AS (
  VALUES (1, 1, 16, 17, 23, 16), (2, 8, 23, 24, 30, 23), (3, 15, 30, NULL, NULL, 999999)),
rws AS (SELECT interval_id, e AS ls, logs.* FROM logs JOIN iv ON day BETWEEN b AND e),
pop AS (SELECT DISTINCT interval_id, user_id FROM register JOIN iv ON day <= bound),
acted AS (SELECT DISTINCT interval_id, user_id FROM logs JOIN iv ON day BETWEEN lb AND le WHERE part <> 'register'),
labels_ AS (
  SELECT pop.interval_id, pop.user_id, CAST(acted.user_id IS NOT NULL AS INTEGER) AS label
  FROM pop LEFT JOIN acted ON acted.interval_id = pop.interval_id AND acted.user_id = pop.user_id
  WHERE pop.interval_id < 3)
"""

G = "interval_id, user_id, part"
_SKEW = "round(CASE WHEN count({x}) >= 3 THEN coalesce(skewness({x}), 0) END, 6)"
_WINDOWED = f"""
w AS (
  SELECT *,
    coalesce(day - lag(day) OVER (PARTITION BY {G} ORDER BY seq), 0) AS gap,
    dense_rank() OVER (PARTITION BY {G} ORDER BY day DESC) AS rnk,
    CASE WHEN day - lag(day) OVER (PARTITION BY {G} ORDER BY day, seq) = 1 THEN 0 ELSE 1 END AS brk
  FROM rws),
islands AS (
  SELECT *, sum(brk) OVER (PARTITION BY {G} ORDER BY day, seq ROWS UNBOUNDED PRECEDING) AS island FROM w),
runs AS (SELECT {G}, island, count(*) AS sz FROM islands GROUP BY {G}, island),
daily AS (SELECT {G}, day, count(*) AS n, count(page) AS n_page, count(action_type) AS n_action FROM rws GROUP BY {G}, day)
"""


def _bigint(sql: str) -> str:
    return f"CAST({sql} AS BIGINT)"


def _double(sql: str) -> str:
    return f"round(CAST({sql} AS DOUBLE), 6)"


# statistic -> (CTE it is computed from, SQL)
_STATS = {
    "count": ("rws", _bigint("count(day)")),
    "max": ("rws", _bigint("max(day)")),
    "min": ("rws", _bigint("min(day)")),
    "mean": ("rws", _double("avg(day)")),
    "last": ("rws", _bigint("max_by(day, seq)")),
    "uni": ("rws", _bigint("count(DISTINCT day)")),
    "radio": ("rws", _double("count(DISTINCT day) / CAST(count(day) AS DOUBLE)")),
    "recency": ("rws", _bigint("max(ls) - max(day)")),
    "diff_max": ("w", _bigint("max(gap)")),
    "diff_min": ("w", _bigint("min(gap)")),
    "diff_mean": ("w", _double("avg(gap)")),
    "diff_ske": ("w", _SKEW.format(x="gap")),
    "diff_last": ("w", _bigint("max_by(gap, seq)")),
    "rank_count": ("w", _bigint("count(rnk)")),
    "rank_max": ("w", _bigint("max(rnk)")),
    "rank_min": ("w", _bigint("min(rnk)")),
    "rank_mean": ("w", _double("avg(rnk)")),
    "rank_median": ("w", _double("median(rnk)")),
    "rank_skew": ("w", _SKEW.format(x="rnk")),
    "rank_std": ("w", _double("stddev_samp(rnk)")),
    "rank_last": ("w", _bigint("max_by(rnk, seq)")),
    "volume_var": ("daily", _double("var_samp(n)")),
    "max_lx_days": ("runs", _bigint("max(sz)")),
    "last_lx_days": ("runs", _bigint("coalesce(max_by(sz, island) FILTER (WHERE sz >= 2), 1)")),
    "lx_var": ("runs", _double("coalesce(var_pop(sz) FILTER (WHERE sz >= 2), 0)")),
    "page_nui": ("rws", _bigint("count(DISTINCT page)")),
    "action_type_nui": ("rws", _bigint("count(DISTINCT action_type)")),
}
for _k in range(1, 7):
    _STATS[f"ls_{_k}"] = ("rws", f"nullif({_bigint(f'count(*) FILTER (WHERE day = ls - {_k})')}, 0)")
for _n, _w in ((3, 0.7), (5, 0.3), (7, 0.1)):
    _rows = f"count(*) FILTER (WHERE day <= ls AND day > ls - {_n})"
    _STATS[f"ls_day{_n}"] = ("rws", _double(f"nullif({_rows}, 0) * CAST({_w} AS DOUBLE)"))
for _code, _domain in (("page", 5), ("action_type", 6)):
    _short = _code.split("_")[0]
    for _v in range(_domain):
        _rows = f"count(*) FILTER (WHERE {_code} = {_v})"
        _STATS[f"{_code}_{_v}"] = ("rws", f"nullif({_bigint(_rows)}, 0)")
        _STATS[f"{_code}{_v}_percent"] = ("rws", _double(f"{_rows} / CAST(nullif(count({_code}), 0) AS DOUBLE)"))
    for _name, _fn in (("max", "max"), ("min", "min")):
        _STATS[f"day_{_short}_count_{_name}"] = ("daily", _bigint(f"{_fn}(n_{_short})"))
    for _name, _fn in (("mean", "avg"), ("std", "stddev_samp")):
        _STATS[f"day_{_short}_count_{_name}"] = ("daily", _double(f"{_fn}(n_{_short})"))
STATS = _STATS


def with_base(select: str, *ctes: str) -> str:
    return "WITH " + ",".join([BASE, *ctes]) + select


def in_order(sql: str, seq: str) -> str:
    """The same query on logs whose rows stand in the order of ``seq``."""
    return sql.replace("event_id AS seq", f"{seq} AS seq")


ROLLING = 200


def rolling(sql: str) -> str:
    """The same query over ``ROLLING`` weeks spread over the days of the launch log, three label days behind each."""
    start = BASE.index("iv(interval_id")
    given = BASE[start : BASE.index("rws AS", start)]
    weeks = f"""span AS (SELECT min(day) AS f, max(day) AS l FROM logs WHERE part = 'launch'),
iv AS (
  SELECT CAST(i + 1 AS INTEGER) AS interval_id, CAST(f + i * greatest(l - f - 5, 1) // {ROLLING} AS INTEGER) AS b,
    b + 6 AS e, b + 7 AS lb, b + 9 AS le, b + 6 AS bound
  FROM span, (SELECT unnest(range({ROLLING})) AS i)),
"""
    return sql.replace(given, weeks).replace("WHERE pop.interval_id < 3", "")


def agreement(rows: str) -> str:
    """``rows``, each with ``agrees`` true: what a comparison of two ways must return."""
    return f"WITH {BASE} SELECT *, true AS agrees FROM ({rows})"


def _stat_ctes(log: str, names: dict[str, str]) -> tuple[list[str], list[str]]:
    """CTEs (one per source) with the named statistics of a log, and their names."""
    by_source: dict[str, list[str]] = {}
    for name, stat in names.items():
        source, sql = STATS[stat]
        by_source.setdefault(source, []).append(f"{sql} AS {name}")
    ctes, aliases = [], []
    for source, columns in by_source.items():
        alias = f"{log}_{source}"
        aliases.append(alias)
        ctes.append(
            f"{alias} AS (SELECT interval_id, user_id, {', '.join(columns)} FROM {source}"
            f" WHERE part = '{log}' GROUP BY interval_id, user_id)"
        )
    return ctes, aliases


def log_stats(log: str, names: dict[str, str]) -> str:
    """One row per (interval, user) of a log, with output column -> statistic."""
    ctes, aliases = _stat_ctes(log, names)
    joins = "".join(f" JOIN {a} USING (interval_id, user_id)" for a in aliases[1:])
    return with_base(
        f" SELECT interval_id, user_id, {', '.join(names)} FROM {aliases[0]}{joins}", _WINDOWED, *ctes
    )


_SCALARS = """
scal AS (
  SELECT interval_id,
    max(day) FILTER (WHERE part = 'register') AS register_max,
    min(day) FILTER (WHERE part = 'create') AS create_min,
    avg(day) FILTER (WHERE part = 'create') AS create_mean,
    avg(day) FILTER (WHERE part = 'launch') AS launch_mean,
    min(day) FILTER (WHERE part = 'activity') AS activity_min
  FROM rws GROUP BY interval_id)"""

_NUI = """
nui AS (
  SELECT interval_id, user_id, count(DISTINCT video_id) AS video, count(DISTINCT author_id) AS author,
    count(DISTINCT action_type) AS action_type, count(DISTINCT page) AS page, count(*) AS n
  FROM rws WHERE part = 'activity' GROUP BY interval_id, user_id)"""

# Means are recomputed here so that the rounding happens once, at the end.
_EXACT = """
exact_ AS (
  SELECT interval_id, user_id,
    max_by(day, seq) FILTER (WHERE part = 'create') AS c_last, min(day) FILTER (WHERE part = 'create') AS c_min,
    avg(day) FILTER (WHERE part = 'create') AS c_mean,
    max_by(day, seq) FILTER (WHERE part = 'register') AS r_last,
    max_by(day, seq) FILTER (WHERE part = 'launch') AS l_last, avg(day) FILTER (WHERE part = 'launch') AS l_mean,
    max_by(day, seq) FILTER (WHERE part = 'activity') AS a_last, min(day) FILTER (WHERE part = 'activity') AS a_min
  FROM rws GROUP BY interval_id, user_id)"""

DERIVED = {
    "create_register_day": _bigint("c_last - register_max"),
    "create_register_day_min": _bigint("c_min - create_min"),
    "create_register_day_mean": _double("c_mean - create_mean"),
    "register_register_day": _bigint("r_last - register_max"),
    "launch_register_day": _bigint("l_last - register_max"),
    "launch_register_day_mean": _double("l_mean - launch_mean"),
    "activity_register_day": _bigint("a_last - register_max"),
    "activity_register_day_min": _bigint("a_min - activity_min"),
    "activity_register_day_first": _bigint("a_min - register_max"),
}
NUI = {f"user_id_{a}_nui": _bigint(f"nui.{a}") for a in ("video", "author", "action_type", "page")} | {
    f"user_id_{a}_nui_ratio": _double(f"nui.{a} / CAST(nui.n AS DOUBLE)")
    for a in ("video", "author", "action_type", "page")
}


def matrix(catalogue: dict[str, tuple[str, str]], columns: tuple[str, ...] = FEATURES, where: str = "") -> str:
    """The feature matrix; ``catalogue`` maps output column -> (log, statistic)."""
    ctes, aliases = [], []
    for log in ("create", "register", "launch", "activity"):
        names = {name: stat for name, (part, stat) in catalogue.items() if part == log and name not in NUI}
        more, named = _stat_ctes(log, names)
        ctes += more
        aliases += named
    extra = DERIVED | NUI | {
        "register_day": "reg.day",
        "register_type": "reg.register_type",
        "device_type": "reg.device_type",
        "register_days": _bigint("reg.ls - reg.day"),
    }
    select = ", ".join(f"{extra[c]} AS {c}" if c in extra else c for c in columns)
    reg = (
        "reg AS (SELECT interval_id, e AS ls, user_id, day, register_type, device_type"
        " FROM register JOIN iv ON day BETWEEN b AND e)"
    )
    joins = "".join(f" LEFT JOIN {a} USING (interval_id, user_id)" for a in [*aliases, "nui", "exact_", "reg", "labels_"])
    return with_base(
        f" SELECT interval_id, user_id, {select}, label FROM pop{joins} LEFT JOIN scal USING (interval_id){where}",
        _WINDOWED, _SCALARS, _NUI, _EXACT, reg, *ctes,
    )


_SCORED = """
scored AS (
  SELECT l.interval_id, l.user_id, l.label, coalesce(a.n, 0) / (coalesce(a.n, 0) + 5.0::DOUBLE) AS score
  FROM labels_ l LEFT JOIN (
    SELECT interval_id, user_id, count(*) AS n FROM rws WHERE part = 'activity' GROUP BY ALL) a
  USING (interval_id, user_id))"""


def simple() -> dict[str, str]:
    """The queries that are not per-user statistics of one log."""
    return {
        "tsv_scan_activity": with_base(
            " SELECT user_id, day AS user_activity_day, page, CAST(video_id AS BIGINT) AS video_id,"
            " CAST(author_id AS BIGINT) AS author_id, action_type FROM logs WHERE part = 'activity'"
        ),
        "tsv_scan_create": with_base(" SELECT user_id, day AS video_create_day FROM logs WHERE part = 'create'"),
        "tsv_scan_register": with_base(
            " SELECT user_id, day AS register_day, register_type, device_type FROM register"
        ),
        "tsv_scan_launch": with_base(" SELECT user_id, day AS app_launch_day FROM logs WHERE part = 'launch'"),
        "five_cuts": with_base(
            """ SELECT interval_id, cut, part AS log, user_id, day, CAST(seq AS BIGINT) AS seq FROM logs JOIN (
              SELECT interval_id, 'features' AS cut, b, e FROM iv
              UNION ALL SELECT interval_id, 'label', lb, le FROM iv WHERE lb IS NOT NULL) ON day BETWEEN b AND e"""
        ),
        "csv_scan_register": with_base(
            " SELECT user_id, day AS register_day, register_type, device_type FROM register"
        ),
        "id_scan_launch": with_base(" SELECT user_id FROM logs WHERE part = 'launch'"),
        "interval_cut": with_base(
            " SELECT part AS log, user_id, day, CAST(seq AS BIGINT) AS seq FROM logs WHERE day BETWEEN 1 AND 16"
        ),
        "interval_assign_rolling": rolling(with_base(
            " SELECT interval_id, part AS log, user_id, day, CAST(seq AS BIGINT) AS seq FROM rws WHERE part = 'launch'"
        )),
        "labels_rolling": rolling(with_base(" SELECT * FROM labels_")),
        "interval_assign": with_base(" SELECT interval_id, part AS log, user_id, day, CAST(seq AS BIGINT) AS seq FROM rws"),
        "label_build": with_base(" SELECT * FROM labels_"),
        "score_population": with_base(" SELECT user_id FROM pop WHERE interval_id = 3"),
        "population_by_interval": with_base(" SELECT * FROM pop"),
        "active_ids_union": with_base(" SELECT DISTINCT user_id FROM logs WHERE part <> 'register'"),
        "label_week_active_ids": with_base(" SELECT * FROM acted"),
        "log_scalars": with_base(
            f" SELECT interval_id, {_bigint('register_max')} AS register_max, {_bigint('create_min')} AS create_min,"
            f" {_double('create_mean')} AS create_mean, {_double('launch_mean')} AS launch_mean,"
            f" {_bigint('activity_min')} AS activity_min FROM scal",
            _SCALARS,
        ),
        "global_offsets": with_base(
            " SELECT interval_id, user_id, " + ", ".join(f"{sql} AS {name}" for name, sql in DERIVED.items())
            + " FROM pop LEFT JOIN exact_ USING (interval_id, user_id) LEFT JOIN scal USING (interval_id)",
            _SCALARS, _EXACT,
        ),
        "distinct_counts_activity": with_base(
            " SELECT interval_id, user_id, " + ", ".join(f"{sql} AS {name}" for name, sql in NUI.items()) + " FROM nui", _NUI
        ),
        "day_gaps": with_base(f" SELECT {G}, CAST(seq AS BIGINT) AS seq, day, CAST(gap AS INTEGER) AS gap FROM w", _WINDOWED),
        "dense_rank_days": with_base(
            f" SELECT {G}, day, CAST(max(rnk) AS BIGINT) AS day_rank, count(*) AS n FROM w GROUP BY {G}, day", _WINDOWED
        ),
        "auc_exact": with_base(
            """ SELECT interval_id, round(sum(CASE WHEN p.score > q.score THEN 1.0::DOUBLE WHEN p.score = q.score
              THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) / count(*), 6) AS auc
            FROM (SELECT * FROM scored WHERE label = 1) p JOIN (SELECT interval_id, score FROM scored WHERE label = 0) q
            USING (interval_id) GROUP BY interval_id""",
            _SCORED,
        ),
        "log_loss": with_base(
            """ SELECT interval_id, round(avg(-CASE WHEN label = 1 THEN ln(greatest(score, 2.220446049250313e-16::DOUBLE))
              ELSE ln(1 - score) END), 6) AS log_loss FROM scored GROUP BY interval_id""",
            _SCORED,
        ),
    }


def model_columns(catalogue: dict[str, tuple[str, str]], where: str = "") -> str:
    return matrix(catalogue, MODEL_FEATURES, where)


def _tree(node) -> str:
    if not isinstance(node, tuple):
        return f"{node}::DOUBLE"
    feature, threshold, left, right = node
    return f"CASE WHEN coalesce({feature}, -9999) <= {threshold}::DOUBLE THEN {_tree(left)} ELSE {_tree(right)} END"


def _splits(node) -> list[str]:
    return [node[0], *_splits(node[2]), *_splits(node[3])] if isinstance(node, tuple) else []


def ensemble(
    catalogue: dict[str, tuple[str, str]], trees: tuple, patience: int, inputs: tuple[str, ...]
) -> dict[str, str]:
    """The queries on the trees of ``fixtures.ensemble``."""
    used = tuple(sorted({name for tree in trees for name in _splits(tree)}))
    outputs = " UNION ALL ".join(
        f"SELECT interval_id, user_id, label, {i} AS round, {_tree(t)} AS v FROM matrix_" for i, t in enumerate(trees, 1)
    )
    base = f"""WITH matrix_ AS ({matrix(catalogue, used)}), outputs AS ({outputs}),
      scored_ AS (SELECT interval_id, user_id, label, round, 1 / (1 + exp(-2 * sum(v) OVER (
        PARTITION BY interval_id, user_id ORDER BY round))) AS score FROM outputs),
      ranked AS (SELECT round, label, avg(place) OVER (PARTITION BY round, score) AS r FROM (
        SELECT round, label, score, row_number() OVER (PARTITION BY round ORDER BY score) AS place
        FROM (SELECT round, label, round(score, 12) AS score FROM scored_ WHERE interval_id = 2))),
      aucs AS (SELECT round, (sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1)
        * (count(*) FILTER (WHERE label = 1) + 1) / 2.0::DOUBLE)
        / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)) AS auc FROM ranked GROUP BY round),
      led AS (SELECT round, auc, (SELECT min(b.round) FROM aucs b WHERE b.round <= a.round AND b.auc = (
        SELECT max(c.auc) FROM aucs c WHERE c.round <= a.round)) AS lead FROM aucs a),
      best AS (SELECT lead AS best_round FROM led
        WHERE round = coalesce((SELECT min(round) FROM led WHERE round - lead >= {patience}), {len(trees)}))"""
    nodes = ", ".join(f"({i}, '{name}')" for i, t in enumerate(trees, 1) for name in _splits(t))
    names = ", ".join(f"('{name}')" for name in inputs)
    return {
        "ensemble_round_auc": base + " SELECT CAST(round AS INTEGER) AS round, round(auc, 6) AS auc FROM aucs",
        "ensemble_choice": base + """ SELECT CAST(best_round AS INTEGER) AS best_round,
          (SELECT round(auc, 6) FROM aucs WHERE round = best_round) AS auc,
          (SELECT round(avg(-CASE WHEN label = 1 THEN ln(score) ELSE ln(1 - score) END), 6) FROM scored_
           WHERE interval_id = 2 AND round = best_round) AS log_loss FROM best""",
        "ensemble_importance": base + f""", nodes(tree, feature) AS (VALUES {nodes}), inputs(feature) AS (VALUES {names}),
          counted AS (SELECT i.feature, count(n.tree) AS important FROM inputs i LEFT JOIN nodes n
            ON n.feature = i.feature AND n.tree <= (SELECT best_round FROM best) GROUP BY i.feature)
          SELECT feature, CAST(important AS BIGINT) AS important,
            CAST(row_number() OVER (ORDER BY important, feature) AS INTEGER) AS place FROM counted""",
    } | dict.fromkeys(
        ("ensemble_scores", "submission_ids"),
        base + f" SELECT user_id, round(score, 6) AS result FROM scored_ WHERE interval_id = 3 AND round = {len(trees)}",
    )
