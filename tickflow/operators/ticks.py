"""Cleaning, conflating and resampling of ticks (symbol, price, event_time)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.timegrid import floor_div, floor_time, grid_index, grid_time


def valid_ticks(ticks: DataFrame) -> DataFrame:
    """Only ticks with a price and a time."""
    return ticks.filter(F.col("price").isNotNull() & F.col("event_time").isNotNull())


def fill_placeholder_ticks(ticks: DataFrame) -> DataFrame:
    """Price 0.0 where no price is known yet, so that every record can be sent."""
    return ticks.withColumn("price", F.coalesce("price", F.lit(0.0)))


def drop_placeholder_ticks(ticks: DataFrame) -> DataFrame:
    """Without the 0.0 records that stand for "no price known yet"."""
    return ticks.filter(F.col("price") > 0)


def normalize_ticks(quotes: DataFrame, slot: timedelta) -> DataFrame:
    """Price text to double (NULL if it is no number) and event time rounded down to the slot."""
    return quotes.select(
        "symbol",
        F.col("price").try_cast("double").alias("price"),
        floor_time(F.col("event_time"), slot).alias("event_time"),
    )


def conflate_latest(ticks: DataFrame, slot: timedelta) -> DataFrame:
    """The latest price per symbol and slot; at one instant the higher price wins, and ticks without a price never do."""
    index = _conflated(ticks, slot)
    return index.select("symbol", grid_time(F.col("slot"), slot).alias("slot"), "price")


def _conflated(ticks: DataFrame, slot: timedelta) -> DataFrame:
    return (
        valid_ticks(ticks)
        .groupBy("symbol", grid_index(F.col("event_time"), slot).alias("slot"))
        .agg(F.max_by("price", F.struct("event_time", "price")).alias("price"))
    )


def _with_following(blocks: DataFrame, group: int) -> DataFrame:
    """``blocks`` (symbol, block and others, one row each) with the symbol's next block (``following``, NULL for the last).

    Blocks are ordered inside groups of ``group`` successive ones; the last of a group is followed by the first of the
    next group that has any. Of a group only its number goes on, so of a symbol with a million blocks a few hundred.
    """
    rows = blocks.withColumn("part", floor_div(F.col("block"), group))
    parts = rows.groupBy("symbol", "part").agg(F.min("block").alias("opening"))
    listed = parts.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("part", "opening"))).alias("listed"))
    nexts = listed.select(
        "symbol", F.inline(F.arrays_zip(F.col("listed.part").alias("part"), F.expr("slice(listed.opening, 2, 2147483647)").alias("opening")))
    )
    inside = F.lead("block").over(Window.partitionBy("symbol", "part").orderBy("block"))
    return (
        rows.withColumn("inside", inside)
        .join(nexts, ["symbol", "part"], "left")
        .withColumn("following", F.coalesce("inside", "opening"))
        .drop("part", "inside", "opening")
    )


def locf_resample(ticks: DataFrame, slot: timedelta, block_slots: int = 4096, group_blocks: int = 4096) -> DataFrame:
    """One row per symbol and slot between the symbol's first and last tick, carrying the last price forward.

    A symbol's history is cut into blocks of ``block_slots`` slots, so that no task holds more than one block of a
    symbol however many ticks it has. One row per (symbol, block), its last price, tells the price the next block starts
    from; these rows are ordered in groups of ``group_blocks``. From there every block is filled on its own.
    """
    latest = _conflated(ticks, slot).filter(F.col("symbol").isNotNull())
    latest = latest.withColumn("block", floor_div(F.col("slot"), block_slots))

    last_prices = latest.groupBy("symbol", "block").agg(F.max_by("price", "slot").alias("price"))
    carried = (
        _with_following(last_prices, group_blocks)
        .filter(F.col("following").isNotNull())
        .select("symbol", "price", F.explode(F.sequence(F.col("block") + 1, F.col("following"))).alias("block"))
    )
    # At each block start the carried price opens the block (kind 0, before a tick of the same slot) and, as a row
    # that is not filled itself (kind 2), ends the last fill of the block before.
    start = F.col("block") * F.lit(block_slots)
    edges = carried.select(
        "symbol",
        "price",
        start.alias("slot"),
        F.explode(
            F.array(
                F.struct(F.col("block"), F.lit(0).alias("kind")),
                F.struct((F.col("block") - 1).alias("block"), F.lit(2).alias("kind")),
            )
        ).alias("edge"),
    ).select("symbol", "edge.block", "slot", "edge.kind", "price")
    points = latest.select("symbol", "block", "slot", F.lit(1).alias("kind"), "price").unionByName(edges)

    by_block = Window.partitionBy("symbol", "block").orderBy("slot", "kind")
    until = F.coalesce(F.lead("slot").over(by_block), F.col("slot") + 1)
    return (
        points.withColumn("until", until)
        .filter((F.col("kind") < 2) & (F.col("until") > F.col("slot")))
        .select("symbol", F.explode(F.sequence(F.col("slot"), F.col("until") - 1)).alias("slot"), "price")
        .select("symbol", grid_time(F.col("slot"), slot).alias("slot"), "price")
    )
