import math
import random
import statistics
from datetime import timedelta

import pytest
from helpers import START, seconds_of
from pyspark.sql import functions as F

from tickflow.functions.records import TICK
from tickflow.operators import moving
from tickflow.plans.params import REFERENCE, TickParams

SHORT = REFERENCE.only("30s", "1m")
ODD = TickParams(
    slide=timedelta(seconds=2),
    windows=tuple((f"w{k}", timedelta(seconds=2 * k)) for k in (1, 4, 7, 13, 22)),
)


def brute_force(ticks, params):
    """{(symbol, end seconds): [(avg, std) per window]} from (symbol, price, seconds), window by window."""
    slide = params.slide.total_seconds()
    lengths = [length.total_seconds() for _, length in params.windows]
    ends = {
        (symbol, (math.floor(at / slide) + i) * slide)
        for symbol, _, at in ticks
        for i in range(1, params.panes(params.labels[0]) + 1)
    }
    result = {}
    for symbol, end in ends:
        row = []
        for length in lengths:
            prices = [p for s, p, at in ticks if s == symbol and end - length <= at < end and p is not None]
            row.append(
                (
                    sum(prices) / len(prices) if prices else None,
                    statistics.stdev(prices) if len(prices) > 1 else None,
                )
            )
        result[symbol, end] = row
    return result


def collected(stats, params):
    return {
        (r["symbol"], seconds_of(r["timestamp"])): [(r[f"avg_{w}"], r[f"std_{w}"]) for w in params.labels]
        for r in stats.collect()
    }


def assert_same(actual, expected):
    assert actual.keys() == expected.keys()
    for key, row in expected.items():
        for got, want in zip(actual[key], row, strict=True):
            for a, b in zip(got, want, strict=True):
                assert (a is None and b is None) or a == pytest.approx(b, rel=1e-9, abs=1e-9), key


def random_ticks(seed, n=300, span=900.0):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        # Busy and empty stretches, so that gaps shorter and longer than the windows occur.
        at = round(r.choice([r.uniform(0, 40), r.uniform(0, span), r.uniform(600, 610)]), 3)
        price = None if r.random() < 0.05 else round(60000 + r.gauss(0, 5), 2)
        rows.append((r.choice("ABC"), price, at))
    return rows


@pytest.mark.parametrize("params", [REFERENCE.only("30s", "1m", "5m"), ODD, REFERENCE], ids=["ref", "odd", "all"])
@pytest.mark.parametrize("block_panes", [None, 5, 64])
def test_random_ticks_match_brute_force(spark, params, block_panes):
    rows = random_ticks(seed=7)
    ticks = spark.createDataFrame([(s, p, START + timedelta(seconds=at)) for s, p, at in rows], TICK)
    actual = collected(moving.moving_stats(ticks, params, block_panes), params)
    assert_same(actual, brute_force(rows, params))


def test_join_form_gives_the_same(spark):
    rows = random_ticks(seed=8)
    ticks = spark.createDataFrame([(s, p, START + timedelta(seconds=at)) for s, p, at in rows], TICK)
    one_pass = collected(moving.moving_stats(ticks, SHORT), SHORT)
    assert_same(collected(moving.moving_stats_join(ticks, SHORT), SHORT), one_pass)


def test_windows_are_half_open(make_ticks):
    stats = collected(moving.moving_stats(make_ticks((29.9, 1.0), (30, 5.0)), SHORT), SHORT)
    assert stats["S", 30][0] == (1.0, None)
    assert stats["S", 40][0][0] == 3.0
    assert stats["S", 60][0] == (5.0, None)
    assert ("S", 70) not in stats


def test_row_exists_iff_shortest_window_has_a_tick(make_ticks):
    stats = collected(moving.moving_stats(make_ticks((5, 1.0), (50, 2.0)), SHORT), SHORT)
    assert sorted(end for _, end in stats) == [10, 20, 30, 60, 70, 80]
    assert stats["S", 60] == [(2.0, None), (1.5, pytest.approx(math.sqrt(0.5)))]


def test_constant_price_has_exactly_zero_deviation(make_ticks):
    rows = [(i / 10, 60123.45) for i in range(400)]
    stats = collected(moving.moving_stats(make_ticks(*rows), SHORT), SHORT)
    assert {std for row in stats.values() for _, std in row} == {0.0}


def test_large_prices_keep_a_small_spread(make_ticks):
    rows = [(i, 1e9 + (i % 2) * 1e-3) for i in range(60)] + [(100, 0.0)]
    stats = collected(moving.moving_stats(make_ticks(*rows), SHORT), SHORT)
    prices = [1e9 + (i % 2) * 1e-3 for i in range(60)]
    assert stats["S", 60][1][1] == pytest.approx(statistics.stdev(prices), rel=1e-3)


def test_null_prices_count_as_ticks_but_not_as_prices(make_ticks):
    stats = collected(moving.moving_stats(make_ticks((1, None), (41, 3.0)), SHORT), SHORT)
    assert stats["S", 10] == [(None, None), (None, None)]
    assert stats["S", 50] == [(3.0, None), (3.0, None)]


def test_null_time_is_ignored_and_null_symbol_is_a_group(make_ticks):
    ticks = make_ticks((1, 1.0, None), (2, 2.0, "A"), (None, 9.0, "A"))
    stats = collected(moving.moving_stats(ticks, SHORT), SHORT)
    assert stats[None, 10][0] == (1.0, None)
    assert stats["A", 10][0] == (2.0, None)
    assert {s for s, _ in collected(moving.moving_stats_join(ticks, SHORT), SHORT)} == {"A"}


def test_ticks_before_the_epoch(make_ticks):
    first = -START.timestamp()
    stats = collected(moving.moving_stats(make_ticks((first - 0.5, 4.0)), SHORT), SHORT)
    assert sorted(end - first for _, end in stats) == [0, 10, 20]


def test_empty_input(make_ticks):
    assert moving.moving_stats(make_ticks((1, 1.0)).limit(0), SHORT).count() == 0


def test_array_form_and_by_window(make_ticks):
    records = moving.as_array(moving.moving_stats(make_ticks((5, 1.0), (6, 3.0)), SHORT), SHORT)
    assert [e["window"] for e in records.first()["windows"]] == ["30s", "1m"]
    rows = moving.by_window(records, "windows")
    assert rows.columns == ["timestamp", "symbol", "window", "avg_price", "std_price"]
    assert rows.count() == 2 * records.count()


def test_single_window(make_ticks):
    rows = moving.moving_avg_std(make_ticks((5, 1.0)), REFERENCE, "1m").collect()
    assert sorted(seconds_of(r["timestamp"]) for r in rows) == [10, 20, 30, 40, 50, 60]


def test_combination_steps_cover_each_window_once():
    for lengths in ([3, 6, 30, 90, 180, 360], [1, 4, 7, 13, 22], [360], [97]):
        covered = {1: {0}}
        for length, parts in moving.combination_steps(lengths):
            panes = [offset + p for part, offset in parts for p in covered[part]]
            assert sorted(panes) == list(range(length))
            covered[length] = set(panes)
        assert set(lengths) <= covered.keys()


def test_plan_reads_three_columns_and_shuffles_twice(spark):
    from tickflow.sources.tables import as_ticks, events

    stats = moving.moving_stats(as_ticks(events(spark, "/root/testdata/sf0.001")), REFERENCE)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert "ReadSchema: struct<ts:timestamp,event_type:string,value:double>" in plan
    assert "partial_var_pop" in plan and "Python" not in plan


def test_hot_symbol_is_spread_over_blocks(spark):
    """Each block of a symbol holds a bounded number of panes, however many ticks there are."""
    ticks = spark.range(200_000).select(
        F.lit("HOT").alias("symbol"),
        (F.col("id") % 7).cast("double").alias("price"),
        F.timestamp_millis(F.col("id") * 50).alias("event_time"),
    )
    blocks = moving._dense_blocks(moving.tick_panes(ticks, SHORT), 3, 6, 12).groupBy("block").count()
    assert blocks.agg(F.max("count")).first()[0] <= 12 + 5
    assert moving.moving_stats(ticks, SHORT, 12).count() == 1002
