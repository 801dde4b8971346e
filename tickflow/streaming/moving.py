"""Moving statistics on a stream.

``moving_stats_writer`` is the form for busy streams: the stream itself only aggregates ticks to panes of one slide, and
each micro-batch runs the batch operator over the panes that have closed and those their windows reach back to. Per
tick that is an update of one small state row and of a mark for each window end at which the tick alone makes a row due.
``stream_window_ends`` does it in a single streaming DataFrame, to be joined or written like any other, at the price of
one update per tick and slide of the longest window.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickflow.functions.moments import exact_avg, exact_stddev, price_moments
from tickflow.functions.timegrid import floor_div, grid_index, grid_time
from tickflow.operators.moving import stats_of_panes, window_moments
from tickflow.plans.params import TickParams, interval, micros
from tickflow.streaming.released import ReleasedRows

PANE_COLUMNS = "symbol string, pane bigint, ticks bigint, n bigint, mean double, m2 double"

Sink = Callable[[DataFrame, int], None]


def with_due_marks(ticks: DataFrame, params: TickParams, delay: timedelta) -> DataFrame:
    """Each tick (``ahead`` 0) and a mark in each of the panes after it in which the shortest window still holds it.

    A window's row is due iff the shortest window holds a tick, so every due row has a mark in its last pane, and the
    watermark releases the mark when the window is final, whether or not another tick follows. The watermark is on the
    marks' time ``at``; its delay grows by as much as marks run ahead, so ticks are late as they would be without them.
    """
    shortest = params.panes(params.labels[0])
    ahead = F.explode(F.sequence(F.lit(0), F.lit(shortest - 1))).alias("ahead")
    marks = ticks.filter(F.col("event_time").isNotNull()).select("symbol", "price", "event_time", ahead)
    at = F.timestamp_micros(F.unix_micros("event_time") + F.col("ahead").cast("long") * F.lit(micros(params.slide)))
    return marks.withColumn("at", at).withWatermark("at", interval(delay + (shortest - 1) * params.slide))


def tick_moments() -> list[Column]:
    """Price moments of the ticks among the marks."""
    own = F.col("ahead") == 0
    return [F.count(F.when(own, 1)).alias("ticks"), *price_moments(F.when(own, F.col("price")))[1:]]


def stream_panes(ticks: DataFrame, params: TickParams) -> DataFrame:
    """Price moments per symbol and pane, put out once when the watermark has passed the pane; ``ticks`` is 0 for a pane
    that only holds marks."""
    return (
        with_due_marks(ticks, params, params.moving_delay)
        .groupBy(F.window("at", interval(params.slide)), "symbol")
        .agg(*tick_moments())
        .select("symbol", grid_index(F.col("window.start"), params.slide).alias("pane"), "ticks", "n", "mean", "m2")
    )


def moving_stats_writer(ticks: DataFrame, params: TickParams, folder: str, sinks: list[Sink]) -> DataStreamWriter:
    """Moving statistics (wide form) of a stream, handed to every sink as (rows, batch id).

    Each batch puts out the windows whose last pane it closed, which are all windows that end at or before the
    watermark and were not out before. ``folder``, shared by the executors, keeps the closed panes that later windows
    reach back to. Whatever a repeated batch writes replaces what it wrote before.
    """
    store = ReleasedRows(ticks.sparkSession, folder, PANE_COLUMNS)
    longest = params.largest // params.slide

    def write_batch(panes: DataFrame, batch_id: int) -> None:
        panes.persist()
        try:
            before = store.reached(batch_id - 1)
            newest = panes.agg(F.max("pane")).first()[0]
            first = None if before is None else before + 2 - longest
            if newest is not None:
                keep_panes(store, panes, batch_id, longest)
                moments = window_moments(known_panes(store, first, longest), params)
                to_sinks(stats_of_panes(closed_windows(moments, before, newest), params), batch_id, sinks)
            store.finish(batch_id, before if newest is None else newest, None if first is None else first // longest)
        finally:
            panes.unpersist()

    return stream_panes(ticks, params).writeStream.foreachBatch(write_batch).outputMode("append")


def keep_panes(store: ReleasedRows, panes: DataFrame, batch_id: int, longest: int) -> None:
    """Keep the panes that hold ticks, in spans of one longest window."""
    store.keep(panes.filter("ticks > 0").withColumn("span", floor_div(F.col("pane"), longest)), batch_id)


def known_panes(store: ReleasedRows, first: int | None, longest: int) -> DataFrame:
    if first is None:
        return store.known(None)
    return store.known(first // longest).filter(F.col("pane") >= first)


def closed_windows(moments: DataFrame, before: int | None, newest: int) -> DataFrame:
    """Those whose last pane lies after ``before`` and not after ``newest``."""
    closed = moments.filter(F.col("pane") <= newest)
    return closed if before is None else closed.filter(F.col("pane") > before)


def to_sinks(rows: DataFrame, batch_id: int, sinks: list[Sink]) -> None:
    if len(sinks) > 1:
        rows.persist()
    try:
        for sink in sinks:
            sink(rows, batch_id)
    finally:
        rows.unpersist()


def stream_window_ends(ticks: DataFrame, params: TickParams) -> DataFrame:
    """All windows in one aggregate over the window ends a tick can count for.

    Each tick meets the ends up to the longest window after it (column ``timestamp``, the watermark column) and is
    counted for a window if the end is near enough. State is one row per symbol and open end, released when the
    watermark passes the end. Ends run ahead of the ticks by up to the longest window, so the delay grows by that
    length: the lateness allowed to a tick stays ``moving_delay`` (rounded up to the slide).

    Ticks are dealt out evenly before they are multiplied, as a topic may have fewer partitions than there are cores.
    """
    longest = params.largest // params.slide
    partitions = int(ticks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shortest = params.panes(params.labels[0])
    pane = grid_index(F.col("event_time"), params.slide)
    per_end = (
        ticks.filter(F.col("event_time").isNotNull())
        .select("symbol", "price", "event_time")
        .repartition(partitions)
        .select("symbol", "price", pane.alias("pane"), F.explode(F.sequence(F.lit(1), F.lit(longest))).alias("ahead"))
        .select("symbol", "price", "ahead", grid_time(F.col("pane") + F.col("ahead"), params.slide).alias("timestamp"))
        .withWatermark("timestamp", interval(params.largest + params.moving_delay))
    )
    statistics: list[Column] = [F.count(F.when(F.col("ahead") <= shortest, 1)).alias("recent")]
    for label in params.labels:
        inside = F.when(F.col("ahead") <= params.panes(label), F.col("price"))
        statistics += [exact_avg(inside).alias(f"avg_{label}"), exact_stddev(inside).alias(f"std_{label}")]
    return per_end.groupBy("symbol", "timestamp").agg(*statistics).filter(F.col("recent") > 0).drop("recent")


def stream_moving_avg_std(ticks: DataFrame, params: TickParams, label: str) -> DataFrame:
    """One sliding window by its end (``timestamp``, which carries the watermark).

    Ends run ahead of the ticks by up to the window, so the delay grows by that length: windows of all lengths are
    released by the same watermark, the last slide boundary less ``moving_delay``.

    Ticks are dealt out evenly before they are multiplied, as in ``stream_window_ends``.
    """
    length = params.panes(label)
    partitions = int(ticks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pane = grid_index(F.col("event_time"), params.slide)
    per_end = (
        ticks.filter(F.col("event_time").isNotNull())
        .select("symbol", "price", pane.alias("pane"))
        .repartition(partitions)
        .select("symbol", "price", "pane", F.explode(F.sequence(F.lit(1), F.lit(length))).alias("ahead"))
        .select("symbol", "price", grid_time(F.col("pane") + F.col("ahead"), params.slide).alias("timestamp"))
        .withWatermark("timestamp", interval(length * params.slide + params.moving_delay))
    )
    average, deviation = exact_avg(F.col("price")), exact_stddev(F.col("price"))
    return per_end.groupBy("symbol", "timestamp").agg(average.alias(f"avg_{label}"), deviation.alias(f"std_{label}"))


def stream_moving_stats_join(ticks: DataFrame, params: TickParams) -> DataFrame:
    """The windows as separate aggregates, joined on (symbol, window end).

    The end is a plain column with the watermark on it, not a field of a window, so each of the joins knows from its key
    when it may forget state.
    """
    parts = [stream_moving_avg_std(ticks, params, label) for label in params.labels]
    joined = reduce(lambda left, right: left.join(right, ["symbol", "timestamp"], "inner"), parts)
    return joined.select("symbol", "timestamp", *[f"{kind}_{label}" for label in params.labels for kind in ("avg", "std")])


def stream_window_counts(ticks: DataFrame, params: TickParams, label: str) -> DataFrame:
    """Ticks and price sum per sliding window; ticks later than the watermark allows are not counted."""
    return (
        ticks.withWatermark("event_time", interval(params.moving_delay))
        .groupBy(F.window("event_time", interval(dict(params.windows)[label]), interval(params.slide)), "symbol")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("sum_price"))
        .select("symbol", F.col("window.end").alias("timestamp"), "n", "sum_price")
    )
