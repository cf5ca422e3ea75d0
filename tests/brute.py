"""Plain-Python definition of the 175 features, row by row, for small logs."""

from __future__ import annotations

import math
import statistics
from collections import Counter, defaultdict

from daygrain.operators.intervals import INTERVALS
from daygrain.sources.logs import LOGS


def skewness(xs):
    n = len(xs)
    if n < 3:
        return None
    mean = sum(xs) / n
    m2 = sum((x - mean) ** 2 for x in xs) / n
    if m2 == 0:
        return 0.0
    m3 = sum((x - mean) ** 3 for x in xs) / n
    return math.sqrt(n * (n - 1)) / (n - 2) * m3 / m2**1.5


def streaks(days):
    """Lengths of the streaks of two days or more, in order of time."""
    days = sorted(days)
    lengths, current = [], 1
    for before, after in zip(days, days[1:]):
        if after - before == 1:
            current += 1
            continue
        if current > 1:
            lengths.append(current)
        current = 1
    if current > 1:
        lengths.append(current)
    return lengths


def sample(fn, xs):
    return fn(xs) if len(xs) > 1 else None


def gaps(days):
    return [0] + [b - a for a, b in zip(days, days[1:])] if days else []


def ranks(days):
    order = {d: i for i, d in enumerate(sorted(set(days), reverse=True), start=1)}
    return [order[d] for d in days]


def log_features(log, rows, ls):
    """Features of one user's cut rows of one log, in file order."""
    spec, days = LOGS[log], [r["day"] for r in rows]
    n = len(days)
    out = {
        f"{log}_day_count": n, f"{log}_day_max": max(days), f"{log}_day_min": min(days),
        f"{log}_day_mean": sum(days) / n, f"{log}_day_last": days[-1],
        f"{log}_day_uni": len(set(days)), f"{log}_day_radio": len(set(days)) / n,
    }
    runs = streaks(days)
    out |= {
        f"{spec.streak}_max_lx_days": max(runs, default=1),
        f"{spec.streak}_last_lx_days": runs[-1] if runs else 1,
        f"{spec.streak}_lx_var": statistics.pvariance(runs) if runs else 0.0,
    }
    for k in range(1, 7):
        out[f"ls_{k}_{spec.offset_word}_cout"] = days.count(ls - k) or None
    for length, weight in ((3, 0.7), (5, 0.3), (7, 0.1)):
        hits = sum(ls - length < d <= ls for d in days)
        out[f"ls_day{length}_{log}_cout"] = weight * hits if hits else None
    if log == "register":
        return out
    g, r, per_day = gaps(days), ranks(days), list(Counter(days).values())
    out |= {spec.size: n, spec.recency: ls - max(days), spec.volume: sample(statistics.variance, per_day)}
    out |= {
        f"{log}_day_diff_max": max(g), f"{log}_day_diff_min": min(g), f"{log}_day_diff_mean": sum(g) / n,
        f"{log}_day_diff_ske": skewness(g), f"{log}_day_diff_last": g[-1],
    }
    out |= {f"rank_{log}_day_{name}": value for name, value in {
        "count": n, "max": max(r), "min": min(r), "mean": sum(r) / n, "median": statistics.median(r),
        "skew": skewness(r), "std": sample(statistics.stdev, r), "last": r[-1]}.items()}
    if log != "activity":
        return out
    for code, domain in (("page", 5), ("action_type", 6)):
        seen = Counter(r[code] for r in rows if r[code] is not None)
        total = sum(seen.values())
        for v in range(domain):
            out[f"{code}_{v}"] = seen.get(v)
            out[f"{code}{v}_percent"] = seen.get(v, 0) / total if total else None
        per_day = defaultdict(int)
        for r_ in rows:
            per_day[r_["day"]] += r_[code] is not None
        counts, short = list(per_day.values()), code.split("_")[0]
        out |= {
            f"act_day_{short}_count_max": max(counts), f"act_day_{short}_count_min": min(counts),
            f"act_day_{short}_count_mean": sum(counts) / len(counts),
            f"act_day_{short}_count_std": sample(statistics.stdev, counts),
        }
    for name, code in (("video", "video_id"), ("author", "author_id"), ("action_type", "action_type"), ("page", "page")):
        kinds = len({r[code] for r in rows if r[code] is not None})
        out |= {f"user_id_{name}_nui": kinds, f"user_id_{name}_nui_ratio": kinds / n}
    return out


def _minus(a, b):
    return None if a is None or b is None else a - b


def matrix(logs):
    """``{(interval_id, user_id): features + label}`` from ``{log: [row dicts in file order]}``."""
    out = {}
    for iv in INTERVALS:
        cut = {log: [r for r in rows if r["day"] is not None and iv.begin <= r["day"] <= iv.end]
               for log, rows in logs.items()}
        days = {log: [r["day"] for r in rows] for log, rows in cut.items()}
        reg_max = max(days["register"], default=None)
        mean = {log: sum(d) / len(d) if d else None for log, d in days.items()}
        low = {log: min(d, default=None) for log, d in days.items()}
        acted = set()
        if iv.label_begin is not None:
            acted = {r["user_id"] for log in ("create", "launch", "activity") for r in logs[log]
                     if r["day"] is not None and iv.label_begin <= r["day"] <= iv.label_end}
        bound = math.inf if iv.registered_by is None else iv.registered_by
        by_user = {log: defaultdict(list) for log in cut}
        for log, rows in cut.items():
            for r in rows:
                by_user[log][r["user_id"]].append(r)
        for user in {r["user_id"] for r in logs["register"] if r["day"] <= bound}:
            f = {}
            for log in LOGS:
                if by_user[log][user]:
                    f |= log_features(log, by_user[log][user], iv.end)
            for r in by_user["register"][user]:
                f |= {"register_day": r["day"], "register_type": r["register_type"],
                      "device_type": r["device_type"], "register_days": iv.end - r["day"]}
            f |= {
                "create_register_day": _minus(f.get("create_day_last"), reg_max),
                "create_register_day_min": _minus(f.get("create_day_min"), low["create"]),
                "create_register_day_mean": _minus(f.get("create_day_mean"), mean["create"]),
                "register_register_day": _minus(f.get("register_day_last"), reg_max),
                "launch_register_day": _minus(f.get("launch_day_last"), reg_max),
                "launch_register_day_mean": _minus(f.get("launch_day_mean"), mean["launch"]),
                "activity_register_day": _minus(f.get("activity_day_last"), reg_max),
                "activity_register_day_min": _minus(f.get("activity_day_min"), low["activity"]),
                "activity_register_day_first": _minus(f.get("activity_day_min"), reg_max),
                "label": int(user in acted) if iv.label_begin is not None else None,
            }
            out[iv.interval_id, user] = f
    return out
