import brute
import helpers
import pytest
from daygrain.operators import day_stats as stats
from daygrain.operators.day_table import cut_days, day_table
from daygrain.operators.gaps import (
    GAP_STATS,
    complete_gap_stats,
    day_gaps,
    folded_gap_stats,
    late_gap_stats,
    out_of_order_users,
    row_gap_stats,
    split_rows,
    split_summaries,
)
from daygrain.operators.intervals import INTERVALS
from daygrain.plans.features import FEATURES, MODEL_FEATURES, feature_matrix, staged_days
from pyspark.sql import functions as F

TYPES = {"double", "bigint", "int"}


def check_matrix(matrix, want):
    rows = matrix.collect()
    assert len(rows) == len(want)
    assert {(r.interval_id, r.user_id) for r in rows} == set(want)
    for row in rows:
        expected = want[row.interval_id, row.user_id]
        for name in (*FEATURES, "label"):
            got = row[name]
            assert helpers.same(got, expected.get(name)), (row.interval_id, row.user_id, name, got, expected.get(name))


@pytest.mark.parametrize("seed,in_order,pieces", [(1, False, 40), (2, True, 40), (3, False, None)])
def test_matrix_matches_brute_force(spark, seed, in_order, pieces):
    logs = helpers.random_logs(seed, in_order=in_order)
    dfs = helpers.frames(spark, logs)
    matrix = feature_matrix(helpers.stacked(spark, logs), dfs["register"], pieces=pieces)
    assert {t for _, t in matrix.dtypes} <= TYPES
    check_matrix(matrix, brute.matrix(logs))


def test_catalogue():
    assert len(FEATURES) == len(set(FEATURES)) == 175
    assert len(MODEL_FEATURES) == 121


def test_empty_logs_give_null_features_and_label_zero(spark):
    logs = helpers.random_logs(4, users=3, rows=0)
    matrix = feature_matrix(helpers.stacked(spark, logs), helpers.frames(spark, logs)["register"])
    check_matrix(matrix, brute.matrix(logs))


def test_batched_intervals_equal_single_intervals(spark):
    logs = helpers.random_logs(5, users=10, rows=150)
    register, stacked = helpers.frames(spark, logs)["register"], helpers.stacked(spark, logs)
    batched = feature_matrix(stacked, register)
    single = feature_matrix(stacked, register, [INTERVALS[1]])
    both = batched.where("interval_id = 2")
    assert both.exceptAll(single).isEmpty() and single.exceptAll(both).isEmpty()


def test_activity_with_null_codes_only(spark):
    logs = helpers.random_logs(6, users=3, rows=0)
    logs["register"][0]["day"] = 3
    logs["activity"] = [{"user_id": 0, "day": 5, "page": None, "action_type": None, "video_id": None, "author_id": None}]
    matrix = feature_matrix(helpers.stacked(spark, logs), helpers.frames(spark, logs)["register"])
    row = matrix.where("interval_id = 1 AND user_id = 0").first()
    assert row.user_id_video_nui == 0 and row.user_id_page_nui == 0
    assert row.page_0 is None and row.page0_percent is None
    assert row.act_day_page_count_max == 0


def test_repeated_registration_keeps_every_raw_row(spark):
    logs = helpers.random_logs(7, users=3, rows=30)
    logs["register"] = [r for r in logs["register"] if r["user_id"] != 1]
    logs["register"] += [{"user_id": 1, "day": d, "register_type": t, "device_type": 1} for d, t in ((2, 0), (9, 1))]
    matrix = feature_matrix(helpers.stacked(spark, logs), helpers.frames(spark, logs)["register"])
    rows = matrix.where("interval_id = 1 AND user_id = 1").orderBy("register_day").collect()
    assert [(r.register_day, r.register_type, r.register_day_count) for r in rows] == [(2, 0, 2), (9, 1, 2)]


@pytest.mark.parametrize("pieces", [1, 60, None])
def test_row_gaps_match_brute_force(spark, pieces):
    logs = helpers.random_logs(8, users=8, rows=200)
    got = day_gaps(helpers.stacked(spark, logs), INTERVALS, pieces).where("part <> 'register'").collect()
    want = {}
    for iv in INTERVALS:
        for log in ("create", "launch", "activity"):
            before = {}
            for seq, r in enumerate(logs[log]):
                if iv.begin <= r["day"] <= iv.end:
                    want[iv.interval_id, r["user_id"], log, seq * 3] = r["day"] - before.get(r["user_id"], r["day"])
                    before[r["user_id"]] = r["day"]
    assert len(got) == len(want)
    assert {(r.interval_id, r.user_id, r.part, r.seq): r.gap for r in got} == want


@pytest.mark.parametrize("pieces", [1, 60, None])
def test_gap_stats_from_rows_equal_gap_stats_from_days(spark, pieces):
    stacked = helpers.stacked(spark, helpers.random_logs(9, users=8, rows=200, in_order=True))
    days = cut_days(day_table(stacked), INTERVALS)
    from_days = stats.summarise_windows(days, stats.gap_stats())
    assert from_days.where("out_of_order").isEmpty()
    keys = ["interval_id", "user_id", "part"]
    pairs = from_days.select(*keys, *[F.col(s).alias(f"d_{s}") for s in GAP_STATS]).join(
        row_gap_stats(stacked, INTERVALS, pieces=pieces), keys, "full"
    )
    for row in pairs.collect():
        for s in GAP_STATS:
            assert helpers.same(row[s], row[f"d_{s}"]), (row, s)


def test_size_equals_day_count_and_shares_sum_to_one(spark):
    logs = helpers.random_logs(10)
    matrix = feature_matrix(helpers.stacked(spark, logs), helpers.frames(spark, logs)["register"])
    assert matrix.where("video_count_sum <> create_day_count OR rank_create_day_max <> create_day_uni").isEmpty()
    shares = " + ".join(f"page{p}_percent" for p in range(5))
    assert matrix.where(f"abs({shares} - 1) > 1e-9").isEmpty()


def test_gap_stats_are_complete_in_any_file_order(spark):
    logs = helpers.random_logs(12, users=8, rows=200)
    want = brute.matrix(logs)
    got = complete_gap_stats(helpers.stacked(spark, logs), INTERVALS, pieces=9).where("part = 'launch'").collect()
    assert got and all(r.diff_max is not None for r in got)
    for r in got:
        if expected := want.get((r.interval_id, r.user_id)):
            for s in GAP_STATS:
                assert helpers.same(r[s], expected[f"launch_day_{s}"]), (r, s)


def test_no_range_of_rows_is_large_however_seq_clusters(spark):
    """One user, one early row, and all others numbered close together."""
    rows = spark.range(40_000).selectExpr(
        "'launch' AS log", "7L AS user_id", "int(1 + id % 30) AS day", "IF(id = 0, 0L, 1000000000000L + id) AS seq"
    )
    pieces = split_rows(rows, 40).groupBy("piece").count().collect()
    assert max(r["count"] for r in pieces) < 4 * 40_000 / 40
    gaps = day_gaps(rows.selectExpr("*", "int(NULL) AS page"), INTERVALS, 40)
    assert gaps.where("interval_id = 1 AND gap NOT IN (0, 1, -15)").isEmpty()


def test_unknown_codes_are_refused(spark):
    logs = helpers.random_logs(13, users=3, rows=10)
    logs["activity"][0] |= {"user_id": 0, "page": 7, "day": 3}
    dfs = helpers.frames(spark, logs)
    with pytest.raises(Exception, match="unknown page: 7"):
        feature_matrix(helpers.stacked(spark, logs), dfs["register"]).collect()


@pytest.mark.parametrize("values", [{5: 10**9, 6: 2, 9: 1}, {0: 10**9, 15: 3}, {29: 10**9, 1: 1}, {1: 1, 2: 1, 30: 10**6}])
def test_skewness_is_exact_for_heavy_users(spark, values):
    from fractions import Fraction
    from math import sqrt

    from daygrain.functions.stats import sample_skewness

    n = sum(values.values())
    sums = [sum(v**p * c for v, c in values.items()) for p in (1, 2, 3)]
    mean = Fraction(sums[0], n)
    m2 = sum(c * (v - mean) ** 2 for v, c in values.items()) / n
    m3 = sum(c * (v - mean) ** 3 for v, c in values.items()) / n
    want = sqrt(n) * sqrt(n - 1) / (n - 2) * float(m3) / float(m2) ** 1.5
    got = spark.range(1).selectExpr(sample_skewness(*[f"{x}L" for x in (n, *sums)]) + " AS s").first().s
    assert abs(got / want - 1) < 1e-9


@pytest.mark.parametrize("size,splits", [(1 << 20, 5), (7, 1), (3, 4)])
def test_split_summaries_fold_to_the_statistics_of_the_rows(spark, size, splits):
    """Splits that follow each other in the file, one user with a third of all rows."""
    logs = helpers.random_logs(14, users=8, rows=300)
    rows = helpers.stacked(spark, logs).repartitionByRange(splits, "log", "seq")
    summaries = split_summaries(rows, INTERVALS, size)
    assert "Exchange" not in summaries._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    got = {(r.interval_id, r.user_id, r.part): r for r in folded_gap_stats(summaries).collect()}
    want = {(r.interval_id, r.user_id, r.part): r for r in row_gap_stats(rows, INTERVALS, 4).where("part <> 'register'").collect()}
    assert set(got) == set(want) and not any(r.interleaved for r in got.values())
    for key, row in want.items():
        for s in GAP_STATS:
            assert helpers.same(got[key][s], row[s]), (key, s)


def test_interleaved_splits_are_seen(spark):
    rows = helpers.stacked(spark, helpers.random_logs(15, users=4, rows=200)).repartition(5)
    assert not folded_gap_stats(split_summaries(rows, INTERVALS)).where("interleaved").isEmpty()


def test_days_in_any_order_need_no_rows(spark):
    """Days one after the other, in a scrambled order: the day table tells."""
    order = [(d * 11) % 31 for d in range(1, 31)]
    logs = {"register": [], "create": [], "activity": [], "launch": [{"user_id": u, "day": d} for d in order for u in (1, 2, 1)]}
    stacked = helpers.stacked(spark, logs)
    days = staged_days(stacked)
    assert out_of_order_users(days).isEmpty() and late_gap_stats(stacked, days, INTERVALS) is None
    got = complete_gap_stats(stacked, INTERVALS).where("part = 'launch'").collect()
    want = {(r.interval_id, r.user_id): r for r in row_gap_stats(stacked, INTERVALS, 3).collect()}
    assert len(got) == len(want) == 6
    for r in got:
        for s in GAP_STATS:
            assert helpers.same(r[s], want[r.interval_id, r.user_id][s]), (r, s)


def test_late_users_beyond_the_broadcast(spark, monkeypatch):
    from daygrain.operators import gaps

    logs = helpers.random_logs(16, users=8, rows=200)
    want = complete_gap_stats(helpers.stacked(spark, logs), INTERVALS)
    monkeypatch.setattr(gaps, "FEW_USERS", 0)
    got = complete_gap_stats(helpers.stacked(spark, logs), INTERVALS)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
