import random
import re
from dataclasses import replace
from datetime import timedelta

import pytest
from helpers import START, seconds_of
from pyspark.sql import functions as F

from tickflow.functions.records import TICK
from tickflow.operators import shortest
from tickflow.plans.params import REFERENCE


def windows(ticks, **kwargs):
    return {
        (r["symbol"], seconds_of(r["timestamp"])): (r["higher_window"], r["lower_window"])
        for r in shortest.shortest_windows(ticks, REFERENCE, **kwargs).collect()
    }


def brute_force(rows, horizon=20.0):
    result = set()
    for symbol, price, at in rows:
        if price is None or at is None:
            continue
        later = [
            (a, p)
            for s, p, a in rows
            if p is not None and a is not None and s is not None and s == symbol and at < a <= at + horizon + 1e-9
        ]
        higher = min((a for a, p in later if p > price), default=None)
        lower = min((a for a, p in later if p < price), default=None)
        result.add((symbol, at, price, higher, lower))
    return result


def found(firsts):
    return {
        (
            r["symbol"],
            seconds_of(r["event_time"]),
            r["price"],
            r["first_higher"] and seconds_of(r["first_higher"]),
            r["first_lower"] and seconds_of(r["first_lower"]),
        )
        for r in firsts.collect()
    }


@pytest.mark.parametrize("seed,prices", [(1, 3), (2, 50), (3, 1000)])
def test_random_ticks_match_brute_force_and_the_pair_form(spark, seed, prices):
    r = random.Random(seed)
    rows = [
        (
            r.choice(["A", "B", None]),
            None if r.random() < 0.03 else float(r.randrange(prices)),
            r.choice([r.randrange(600), r.randrange(3000), r.randrange(200, 400)]) / 10,
        )
        for _ in range(700)
    ]
    ticks = spark.createDataFrame([(s, p, START + timedelta(seconds=at)) for s, p, at in rows], TICK)
    expected = brute_force(rows)
    assert found(shortest.first_higher_lower(ticks, REFERENCE)) == expected
    for busy_block in (100, 7, 1):
        assert found(shortest.first_higher_lower(ticks, REFERENCE, busy_block)) == expected
    assert found(shortest.first_in_pairs(shortest.forward_pairs(ticks, REFERENCE))) == expected


def test_monotone_and_constant_series(make_ticks):
    rising = make_ticks(*[(i / 10, float(i)) for i in range(500)])
    got = windows(rising)
    assert {(round(w[0], 5), w[1]) for (_, at), w in got.items() if at < 49.9} == {(0.1, 20.0)}
    flat = windows(make_ticks(*[(i / 10, 1.0) for i in range(500)]))
    assert set(flat.values()) == {(20.0, 20.0)} and len(flat) == 500


def test_horizon_is_inclusive_and_time_strictly_later(make_ticks):
    got = windows(make_ticks((0, 5.0), (20, 6.0), (100, 5.0), (120.1, 6.0), (200, 5.0), (200, 9.0)))
    assert got["S", 0] == (20.0, 20.0)
    assert got["S", 100] == (20.0, 20.0)
    assert got["S", 200] == (20.0, 20.0)


def test_found_flag_tells_a_hit_at_the_horizon_from_none(make_ticks):
    rows = shortest.shortest_windows(make_ticks((0, 5.0), (20, 6.0)), REFERENCE, with_found=True).collect()
    flags = {seconds_of(r["timestamp"]): (r["higher_found"], r["lower_found"]) for r in rows}
    assert flags == {0: (True, False), 20: (False, False)}


def test_duplicates_collapse_and_symbols_do_not_mix(make_ticks):
    got = windows(make_ticks((0, 5.0, "A"), (0, 5.0, "A"), (1, 6.0, "B"), (2, 4.0, "A")))
    assert got == {("A", 0): (20.0, 2.0), ("B", 1): (20.0, 20.0), ("A", 2): (20.0, 20.0)}


def test_null_symbol_keeps_its_rows_unmatched(make_ticks):
    assert windows(make_ticks((0, 5.0, None), (1, 6.0, None))) == {(None, 0): (20.0, 20.0), (None, 1): (20.0, 20.0)}


def test_pairs_keep_unmatched_ticks(make_ticks):
    rows = shortest.forward_pairs(make_ticks((0, 1.0), (1, 2.0), (50, 3.0)), REFERENCE).collect()
    pairs = sorted((r["price"], r["right_price"]) for r in rows if r["right_price"])
    assert pairs == [(1.0, 2.0)] and len(rows) == 3


def test_busy_block_is_dealt_out(spark):
    """All ticks in one block, many prices per instant: no share holds more than about its part of the questions."""
    ticks = spark.range(40_000).select(
        F.lit("HOT").alias("symbol"),
        F.timestamp_millis((F.col("id") % 20) * 100).alias("event_time"),
        (F.col("id") / 20).cast("int").cast("double").alias("price"),
    )
    placed = shortest._placed(ticks, REFERENCE, 4_000).filter("home")
    shares = placed.groupBy("share").agg(F.sum(F.col("asks").cast("int")).alias("n"), F.count("*").alias("rows"))
    assert shares.count() == 10
    largest = shares.agg(F.max("n"), F.max("rows")).first()
    assert largest[0] < 4_800 and largest[1] - largest[0] <= 2 * 20 + 300
    firsts = shortest.first_higher_lower(ticks, REFERENCE, 4_000)
    assert firsts.count() == 40_000
    # The highest price comes at every instant, so every other price has a higher one 100 ms later.
    late = firsts.filter(F.col("first_higher").isNull() & (F.col("price") < 1999))
    assert late.select("event_time").distinct().count() == 1


def test_many_busy_blocks(spark):
    """Every one of 12,000 blocks is busy; with a small table of them sent to all tasks or shuffled, rows are the same."""
    ticks = spark.range(36_000).select(
        F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
        F.timestamp_millis(F.col("id") * 1_700).alias("event_time"),
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("price"),
    )
    params = replace(REFERENCE, horizon=timedelta(seconds=15))
    assert shortest.busy_blocks(ticks, params, 1).count() > 12_000
    expected = found(shortest.first_higher_lower(ticks, params))
    assert found(shortest.first_higher_lower(ticks, params, 1)) == expected
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        assert found(shortest.first_higher_lower(ticks, params, 1)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_plan_forms_no_pairs(spark):
    from tickflow.sources.tables import as_ticks, events

    rows = shortest.shortest_windows(as_ticks(events(spark, "/root/testdata/sf0.001")), REFERENCE)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan
    assert "Python" not in plan


def tasks_of(rows):
    """The tasks that make rows, and the most rows of one."""
    return rows.groupBy(F.spark_partition_id().alias("task")).count().agg(F.count("*"), F.max("count")).first()


def test_pairs_are_dealt_out_by_their_number(spark):
    """A million pairs and more from a few kilobytes in one file: not all of them in one or two tasks."""
    ticks = spark.range(12_000).select(
        F.lit("S").alias("symbol"),
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("price"),
        F.timestamp_millis(F.col("id") * 10).alias("event_time"),
    ).coalesce(1)
    tasks, largest = tasks_of(shortest.forward_pairs(ticks, REFERENCE))
    pairs = sum(min(2_000, 11_999 - i) for i in range(12_000)) + 1  # and the last tick without one
    assert shortest.forward_pairs(ticks, REFERENCE).count() == pairs
    assert tasks >= 4 and largest < pairs / 2


def test_pairs_shuffle_a_tick_about_once(spark):
    """One shuffle for both sides, in spans that are as long as their number of pairs allows."""

    def spans(ticks_of_block):
        counts = spark.range(1_000).select(F.col("id").alias("block"), F.lit(ticks_of_block).alias("count"))
        return shortest._pair_spans(counts)

    ticks = spark.range(6_000).select(
        F.lit("S").alias("symbol"),
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("price"),
        F.timestamp_millis(F.col("id") * 4_000 - 9_000_000).alias("event_time"),
    )
    rows = shortest.forward_pairs(ticks, REFERENCE)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") == 1 and "Join" not in plan
    assert rows.count() == 5 * 6_000 - 15 + 1  # and the last tick without one
    assert spans(5) == (1, shortest.MOST_QUARTERS)
    tasks, quarters = spans(500)
    assert tasks >= 50 and 4 <= quarters <= 16
    tasks, quarters = spans(50_000)
    assert tasks >= 500 and quarters == shortest.QUARTERS


def test_pairs_in_the_form_shown(spark, make_ticks):
    ticks = make_ticks((0, 1.004), (1, 2.006), (20.5, 3.0), (1, 5.0, None))
    shown = shortest.forward_pairs(ticks, REFERENCE, lambda rows: rows.withColumn("price", F.round("price", 2)))
    after = shortest.forward_pairs(ticks, REFERENCE)
    after = after.withColumns({name: F.round(name, 2) for name in ("price", "right_price")})
    assert shown.columns == after.columns and shown.count() == 4
    assert shown.exceptAll(after).count() == 0 and after.exceptAll(shown).count() == 0


def test_horizon_that_blocks_do_not_divide(make_ticks):
    params = replace(REFERENCE, horizon=timedelta(microseconds=7))
    rows = shortest.forward_pairs(make_ticks(*[(i / 1e6, float(i)) for i in range(40)]), params).collect()
    got = sorted((r["price"], r["right_price"]) for r in rows if r["right_price"] is not None)
    assert got == [(float(i), float(j)) for i in range(40) for j in range(i + 1, min(i + 8, 40))]


def test_rows_of_nodes_are_dealt_out_by_their_number(spark, monkeypatch):
    """Twice the ticks, twice the tasks, whatever Spark makes of the size of the shuffle."""
    monkeypatch.setattr(shortest, "NODE_ROWS", 2_000)

    def tasks(n):
        ticks = spark.range(n).select(
            F.lit("S").alias("symbol"),
            F.timestamp_millis(F.col("id") * 1_000).alias("event_time"),
            F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("price"),
        )
        firsts = shortest.first_higher_lower(ticks, REFERENCE)
        plan = firsts._jdf.queryExecution().executedPlan().toString()
        assert firsts.count() == n
        return int(re.search(r"hashpartitioning\(symbol#\d+, block#\d+L, share#\d+, (\d+)\)", plan).group(1))

    assert tasks(6_000) >= 10
    assert tasks(12_000) >= 20
