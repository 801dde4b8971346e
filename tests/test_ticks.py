import random
from datetime import timedelta

import pytest
from helpers import START, seconds_of
from pyspark.sql import functions as F

from tickflow.functions.records import TICK
from tickflow.operators import ticks as ops

SLOT = timedelta(milliseconds=100)


def test_normalize_floors_time_and_parses_text(spark):
    quotes = spark.createDataFrame(
        [("S", "1.5", START + timedelta(milliseconds=199)), ("S", "abc", START + timedelta(milliseconds=200))],
        "symbol string, price string, event_time timestamp",
    )
    rows = {seconds_of(r["event_time"]): r["price"] for r in ops.normalize_ticks(quotes, SLOT).collect()}
    assert rows == {0.1: 1.5, 0.2: None}


def test_conflate_keeps_the_latest_of_a_slot(make_ticks):
    rows = ops.conflate_latest(make_ticks((0.0, 1.0), (0.09, 2.0), (0.05, 3.0), (0.1, 4.0)), SLOT).collect()
    assert {seconds_of(r["slot"]): r["price"] for r in rows} == {0.0: 2.0, 0.1: 4.0}


def test_a_missing_price_never_replaces_one(make_ticks):
    ticks = make_ticks((0.0, 1.0), (0.05, None), (0.2, None), (0.3, 2.0))
    rows = ops.conflate_latest(ticks, SLOT).collect()
    assert {seconds_of(r["slot"]): r["price"] for r in rows} == {0.0: 1.0, 0.3: 2.0}
    rows = ops.locf_resample(ticks, SLOT).collect()
    assert {seconds_of(r["slot"]): r["price"] for r in rows} == {0.0: 1.0, 0.1: 1.0, 0.2: 1.0, 0.3: 2.0}


def test_valid_and_placeholder_filters(make_ticks):
    ticks = make_ticks((1, 0.0), (2, 5.0), (3, None), (None, 6.0))
    assert [r["price"] for r in ops.valid_ticks(ticks).collect()] == [0.0, 5.0]
    assert sorted(r["price"] for r in ops.fill_placeholder_ticks(ticks).collect()) == [0.0, 0.0, 5.0, 6.0]
    assert sorted(r["price"] for r in ops.drop_placeholder_ticks(ticks).collect()) == [5.0, 6.0]


def carried_forward(rows, width):
    expected = {}
    for symbol in {s for s, _, _ in rows}:
        mine = sorted((at, p) for s, p, at in rows if s == symbol)
        for slot in range(int(mine[0][0] // width), int(mine[-1][0] // width) + 1):
            expected[symbol, slot * width] = [p for at, p in mine if at < (slot + 1) * width][-1]
    return expected


@pytest.mark.parametrize("block_slots", [1, 7, 4096])
def test_carry_forward_over_gaps_and_blocks(spark, block_slots):
    r = random.Random(5)
    rows = [(r.choice("AB"), float(i), float(r.choice([r.randrange(40), r.randrange(300)]))) for i in range(60)]
    rows = list({(s, at): (s, p, at) for s, p, at in rows}.values())
    ticks = spark.createDataFrame([(s, p, START + timedelta(seconds=at)) for s, p, at in rows], TICK)
    got = ops.locf_resample(ticks, timedelta(seconds=2), block_slots).collect()
    assert {(g["symbol"], seconds_of(g["slot"])): g["price"] for g in got} == carried_forward(rows, 2)
    assert len(got) == len(carried_forward(rows, 2))


def test_carry_forward_of_one_tick(make_ticks):
    rows = ops.locf_resample(make_ticks((5, 1.0), (None, 2.0)), SLOT).collect()
    assert [(seconds_of(r["slot"]), r["price"]) for r in rows] == [(5.0, 1.0)]


def test_slots_do_not_depend_on_the_session_time_zone(spark, make_ticks):
    ticks = make_ticks((7200, 1.0))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
    try:
        from tickflow.functions.timegrid import floor_time, naive_utc

        row = ticks.select(naive_utc(floor_time(F.col("event_time"), timedelta(hours=1))).alias("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["t"] == (START + timedelta(hours=2)).replace(tzinfo=None)


def test_blocks_find_the_next_one_across_groups(spark):
    rows = spark.range(200_000).select(
        F.concat(F.lit("S"), F.pmod(F.xxhash64("id"), F.lit(2))).alias("symbol"), (F.col("id") * 7 - 500_000).alias("block")
    )
    rows = rows.filter(~F.col("block").between(-90_000, 60_000))
    found = ops._with_following(rows, 100)
    by_symbol = {}
    for r in rows.collect():
        by_symbol.setdefault(r.symbol, []).append(r.block)
    expected = {}
    for symbol, blocks in by_symbol.items():
        blocks.sort()
        expected |= {(symbol, a): b for a, b in zip(blocks, blocks[1:] + [None])}
    assert {(r.symbol, r.block): r.following for r in found.collect()} == expected
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and all("part#" in line for line in windows)


def test_carry_forward_with_small_blocks_and_groups(make_ticks):
    ticks = make_ticks(*[(at / 10, float(at)) for at in (0, 3, 4, 50, 51, 700, 2_000)], (1.0, 9.0, "T"), (30.0, 8.0, "T"))
    slot = timedelta(milliseconds=100)
    usual = sorted(map(tuple, ops.locf_resample(ticks, slot).collect()))
    assert usual == sorted(map(tuple, ops.locf_resample(ticks, slot, 3, 2).collect())) and len(usual) == 2_001 + 291
