import math

import pytest
from helpers import seconds_of

from tickflow.operators import moving, zscore
from tickflow.plans.params import REFERENCE

PARAMS = REFERENCE.only("30s", "1m")


def scores(ticks, params=PARAMS):
    stats = moving.as_array(moving.moving_stats(ticks, params), params)
    return {
        (r["symbol"], seconds_of(r["timestamp"])): [e["zscore_price"] for e in r["zscores"]]
        for r in zscore.zscore(ticks, stats, params).collect()
    }


def test_band_is_inclusive_on_both_sides(make_ticks):
    ticks = make_ticks((1, 1.0), (2, 3.0), (29.89, 7.0), (29.9, 7.0), (30, 7.0), (30.1, 7.0), (30.11, 7.0))
    assert sorted(at for _, at in scores(ticks)) == [29.9, 30, 30.1]


def test_value(make_ticks):
    ticks = make_ticks((1, 1.0), (2, 3.0), (10, 5.0))
    assert scores(ticks)["S", 10][0] == pytest.approx((5 - 2) / math.sqrt(2))


def test_zero_and_missing_deviation_give_null(make_ticks):
    assert scores(make_ticks((1, 4.0), (2, 4.0), (10, 5.0)))["S", 10] == [None, None]
    assert scores(make_ticks((1, 4.0), (10, 5.0)))["S", 10] == [None, None]


def test_null_symbol_is_dropped_and_symbols_do_not_mix(make_ticks):
    ticks = make_ticks((1, 1.0, "A"), (2, 3.0, "A"), (10, 5.0, "B"), (1, 1.0, None), (10, 2.0, None))
    assert scores(ticks) == {}


def test_wide_tolerance_matches_several_ends(make_ticks):
    from dataclasses import replace
    from datetime import timedelta

    wide = replace(PARAMS, tolerance=timedelta(seconds=12))
    ticks = make_ticks((15, 1.0))
    stats = moving.as_array(moving.moving_stats(ticks, wide), wide)
    assert zscore.zscore(ticks, stats, wide).count() == 1
    near = zscore.near_window_ends(ticks, wide)
    assert sorted(seconds_of(r["window_end"]) for r in near.collect()) == [10, 20]


def test_outlier_flag(spark):
    rows = spark.createDataFrame([(3.1,), (-3.1,), (3.0,), (None,)], "zscore_price double")
    flags = [r["is_outlier"] for r in zscore.flag_outliers(rows).collect()]
    assert flags == [True, True, False, None]
