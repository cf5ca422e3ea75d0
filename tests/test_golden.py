"""Hand-worked rows, for one user of the create log on interval 1."""

import helpers
import pytest
from daygrain.plans.features import feature_matrix


def features_of(spark, days):
    logs = {"create": [{"user_id": 1, "day": d} for d in days], "launch": [], "activity": [],
            "register": [{"user_id": 1, "day": 1, "register_type": 0, "device_type": 0}]}
    matrix = feature_matrix(helpers.stacked(spark, logs), helpers.frames(spark, logs)["register"])
    return matrix.where("interval_id = 1").first()


@pytest.mark.parametrize("days,longest,latest,var", [
    ([5], 1, 1, 0), ([5, 5, 5], 1, 1, 0), ([1, 1, 2, 2, 3], 2, 2, 0), ([1, 2, 3, 7], 3, 3, 0),
    ([1, 2, 3, 7, 8], 3, 2, 0.25), ([1, 2, 5], 2, 2, 0), ([1, 2, 2, 3, 4, 9], 3, 3, 0.25),
])
def test_streaks(spark, days, longest, latest, var):
    row = features_of(spark, days)
    assert (row.cre_max_lx_days, row.cre_last_lx_days, row.cre_lx_var) == (longest, latest, var)


def test_gaps_and_ranks_follow_file_order(spark):
    row = features_of(spark, [4, 2, 9, 9])
    assert (row.create_day_last, row.create_day_max) == (9, 9)
    assert (row.create_day_diff_max, row.create_day_diff_min) == (7, -2)
    assert (row.create_day_diff_mean, row.create_day_diff_last) == (1.25, 0)
    assert (row.rank_create_day_count, row.rank_create_day_max, row.rank_create_day_min) == (4, 3, 1)
    assert (row.rank_create_day_mean, row.rank_create_day_median, row.rank_create_day_last) == (1.75, 1.5, 1)


def test_last_is_not_max(spark):
    row = features_of(spark, [9, 4])
    assert (row.create_day_last, row.create_day_max) == (4, 9)
    assert (row.create_day_diff_min, row.create_day_diff_last) == (-5, -5)


def test_constant_group_and_single_row(spark):
    constant, single = features_of(spark, [6, 6, 6, 6]), features_of(spark, [6])
    assert constant.create_day_diff_ske == 0.0 and constant.rank_create_day_skew == 0.0
    assert constant.rank_create_day_std == 0.0 and constant.video_day_sum_var is None
    assert single.create_day_diff_ske is None and single.rank_create_day_std is None


def test_last_day_counts_in_windows_but_in_no_offset(spark):
    row = features_of(spark, [16])
    assert [row[f"ls_{k}_create_cout"] for k in range(1, 7)] == [None] * 6
    assert (row.ls_day3_create_cout, row.ls_day5_create_cout, row.ls_day7_create_cout) == (0.7, 0.3, 0.1)
    assert row.label == 0
