"""Moving average and sample standard deviation over several sliding windows.

A row (symbol, timestamp) describes the ticks in [timestamp - length, timestamp) for every window length; it exists iff
the shortest window holds a tick.

``moving_stats`` reads the ticks once. Ticks are aggregated to panes one slide long, which Spark combines before the
shuffle, so a symbol with most of the rows costs the shuffle no more than one row per pane and map task. The panes of
a symbol are then cut into time blocks (each with the panes just before it that its windows reach back to), the unit of
the second shuffle: its size is set by ``block_panes`` and not by the data. Inside a block every window is built from
the next shorter one, e.g. a 5 minute window from five 1 minute windows, found with ``lag`` in one sorted pass: a dozen
lookups per row instead of one row per tick, window and slide.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.moments import Span, merged_m2, merged_mean, merged_n, price_moments, sample_stddev
from tickflow.functions.timegrid import floor_div, grid_index, grid_time
from tickflow.plans.params import TickParams

BLOCK_KEYS = ("symbol", "block")


def tick_panes(ticks: DataFrame, params: TickParams) -> DataFrame:
    """Price moments per symbol and pane of one slide."""
    return (
        ticks.filter(F.col("event_time").isNotNull())
        .groupBy("symbol", grid_index(F.col("event_time"), params.slide).alias("pane"))
        .agg(*price_moments(F.col("price")))
    )


def combination_steps(lengths: list[int]) -> list[tuple[int, list[tuple[int, int]]]]:
    """How to build windows of the given lengths (in panes) from shorter ones, starting at single panes.

    Returns, in order, (length, [(part length, offset back in panes), ...]); the first part has offset 0.
    """
    known = {1}
    steps: list[tuple[int, list[tuple[int, int]]]] = []

    def build(length: int) -> None:
        if length in known:
            return
        base = max(k for k in known if length % k == 0)
        ratio = length // base
        factor = next(f for f in range(2, ratio + 1) if ratio % f == 0)
        if factor <= 5:
            part = length // factor
            build(part)
            parts = [(part, i * part) for i in range(factor)]
        else:
            build(length - base)
            parts = [(length - base, 0), (base, length - base)]
        known.add(length)
        steps.append((length, parts))

    for length in sorted(lengths):
        build(length)
    return steps


def window_moments(panes: DataFrame, params: TickParams, block_panes: int | None = None) -> DataFrame:
    """symbol, pane (the last before the window end) and, per window of k panes, the columns n<k>, mean<k>, m2_<k>."""
    lengths = [params.panes(label) for label in params.labels]
    shortest, longest = lengths[0], lengths[-1]
    block_panes = block_panes or 2 * longest
    steps = combination_steps(lengths)
    rows = _dense_blocks(panes, shortest, longest, block_panes)
    for position, (length, parts) in enumerate(steps):
        needed = set(lengths) | {part for _, later in steps[position + 1 :] for part, _ in later}
        rows = _combine(rows, length, parts, needed, shortest)
    return rows.filter(
        (F.col("pane") >= F.col("block") * F.lit(block_panes)) & (F.col(f"ticks{shortest}") > 0)
    ).select("symbol", "pane", *[f"{name}{k}" for k in lengths for name in ("n", "mean", "m2_")])


def window_end(params: TickParams) -> Column:
    return grid_time(F.col("pane") + 1, params.slide).alias("timestamp")


def _dense_blocks(panes: DataFrame, shortest: int, longest: int, block_panes: int) -> DataFrame:
    """Panes by block, with rows for empty panes wherever a window ending there can hold a tick.

    Gaps no window spans are left open: after such a gap nothing can be looked up before it.
    """
    partitions = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pane = F.col("pane")
    first, last = floor_div(pane, block_panes), floor_div(pane + F.lit(longest - 1), block_panes)
    # The number of partitions is stated because the rows filled in below are more than the shuffle's size tells.
    in_blocks = panes.select("*", F.explode(F.sequence(first, last)).alias("block")).repartition(
        partitions, *BLOCK_KEYS
    )
    in_order = Window.partitionBy(*BLOCK_KEYS).orderBy("pane")
    due = pane + F.lit(shortest - 1)
    fill_end = F.when(F.col("following") - pane <= F.lit(longest), F.col("following") - 1).otherwise(due)
    return (
        in_blocks.withColumn("following", F.lead("pane").over(in_order))
        .select("*", F.explode(F.sequence(pane, F.least(fill_end, F.col("following") - 1))).alias("at"))
        .filter(F.col("at") < (F.col("block") + 1) * F.lit(block_panes))
        .selectExpr(
            *BLOCK_KEYS,
            "at AS pane",
            "IF(at = pane, ticks, 0L) AS ticks1",
            "IF(at = pane, n, 0L) AS n1",
            "IF(at = pane, mean, NULL) AS mean1",
            "IF(at = pane, m2, NULL) AS m2_1",
        )
    )


def _combine(
    rows: DataFrame, length: int, parts: list[tuple[int, int]], needed: set[int], shortest: int
) -> DataFrame:
    """Add the moments of the window of ``length`` panes ending at each row, and drop those not ``needed`` any more.

    The number of ticks is followed up to the shortest window only, whose ticks decide which rows are due.
    """
    over = "OVER (PARTITION BY symbol, block ORDER BY pane)"
    counts = ["n", "ticks"] if length <= shortest else ["n"]
    lags = [
        f"lag({name}, {offset}) {over} AS {alias}_{i}"
        for i, (part, offset) in enumerate(parts)
        if offset
        for name, alias in [
            ("pane", "at"),
            (f"mean{part}", "part_mean"),
            (f"m2_{part}", "part_m2"),
            *[(f"{count}{part}", f"part_{count}") for count in counts],
        ]
    ]
    # Rows left out in a gap shift the positions: a row of another pane means that this part is empty.
    present = [
        f"IF(at_{i} = pane - {offset}, part_{count}_{i}, 0L) AS {count}_{i}"
        for i, (_, offset) in enumerate(parts)
        if offset
        for count in counts
    ]
    own = parts[0][0]
    spans = [Span(f"n{own}", f"mean{own}", f"m2_{own}")] + [
        Span(f"n_{i}", f"part_mean_{i}", f"part_m2_{i}") for i in range(1, len(parts))
    ]
    merged = [
        f"{merged_n(spans)} AS n{length}",
        f"{merged_mean(spans)} AS mean{length}",
        f"{merged_m2(spans, f'mean{length}')} AS m2_{length}",
    ]
    if "ticks" in counts:
        ticks = [f"ticks{own}"] + [f"ticks_{i}" for i in range(1, len(parts))]
        merged.append(f"{' + '.join(ticks)} AS ticks{length}")
    dropped = [
        c
        for c in rows.columns
        for prefix in ("n", "mean", "m2_", "ticks")
        if c.startswith(prefix) and c[len(prefix) :].isdigit() and int(c[len(prefix) :]) not in needed
    ]
    helpers = [f"{name}_{i}" for i in range(1, len(parts)) for name in ("at", "part_mean", "part_m2")]
    helpers += [f"{name}_{i}" for i in range(1, len(parts)) for count in counts for name in (f"part_{count}", count)]
    return rows.selectExpr("*", *lags).selectExpr("*", *present, *merged).drop(*dropped, *helpers)


def _statistics(k: int) -> tuple[Column, Column]:
    return F.col(f"mean{k}"), F.expr(sample_stddev(f"n{k}", f"m2_{k}"))


def stats_of_panes(moments: DataFrame, params: TickParams) -> DataFrame:
    """Wide form of ``window_moments``: symbol, timestamp, then avg_<label> and std_<label> per window."""
    columns = []
    for label in params.labels:
        average, deviation = _statistics(params.panes(label))
        columns += [average.alias(f"avg_{label}"), deviation.alias(f"std_{label}")]
    return moments.select("symbol", window_end(params), *columns)


def moving_stats(ticks: DataFrame, params: TickParams, block_panes: int | None = None) -> DataFrame:
    """All windows in one pass over the ticks."""
    return stats_of_panes(window_moments(tick_panes(ticks, params), params, block_panes), params)


def moving_avg_std(ticks: DataFrame, params: TickParams, label: str) -> DataFrame:
    """One window on its own: a row for every slide at which this window holds a tick."""
    average, deviation = _statistics(params.panes(label))
    return window_moments(tick_panes(ticks, params), params.only(label)).select(
        "symbol", window_end(params), average.alias("avg_price"), deviation.alias("std_price")
    )


def moving_stats_join(ticks: DataFrame, params: TickParams) -> DataFrame:
    """``moving_stats`` as separate window aggregates joined on (symbol, timestamp).

    The literal form of the definition, kept to check the one-pass form against. As in any equi-join, rows without a
    symbol are dropped here.
    """
    parts = [
        moving_avg_std(ticks, params, label).withColumnsRenamed(
            {"avg_price": f"avg_{label}", "std_price": f"std_{label}"}
        )
        for label in params.labels
    ]
    return reduce(lambda left, right: left.join(right, ["symbol", "timestamp"], "inner"), parts)


def as_array(stats: DataFrame, params: TickParams) -> DataFrame:
    """Wide form to the record form with one array element per window, shortest first."""
    return stats.select("timestamp", "symbol", F.array(*_window_structs(params)).alias("windows"))


def _window_structs(params: TickParams) -> list[Column]:
    return [
        F.struct(
            F.lit(label).alias("window"),
            F.col(f"avg_{label}").alias("avg_price"),
            F.col(f"std_{label}").alias("std_price"),
        )
        for label in params.labels
    ]


def by_window(records: DataFrame, elements: str) -> DataFrame:
    """Array form to one row per (timestamp, symbol, window)."""
    return records.select("timestamp", "symbol", F.inline(elements))
