"""z-scores on a stream: ticks joined to the moving statistics of the window ends next to them.

``zscore_writer`` takes the statistics from closed panes: the stream holds panes and the few ticks next to a window end,
and each micro-batch joins the ticks it releases to the windows built from the panes. The other forms are stream-stream
joins, with the statistics from a streaming aggregate or from a topic.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickflow.functions.timegrid import grid_index, window_ends_within
from tickflow.operators.moving import as_array, stats_of_panes, window_moments
from tickflow.operators.zscore import near_window_ends, window_zscores, zscore
from tickflow.plans.params import TickParams, interval
from tickflow.streaming.moving import PANE_COLUMNS, Sink, keep_panes, known_panes, stream_window_ends, tick_moments
from tickflow.streaming.moving import to_sinks, with_due_marks
from tickflow.streaming.released import ReleasedRows


def stream_panes_and_near_ticks(ticks: DataFrame, params: TickParams) -> DataFrame:
    """Panes as ``stream_panes`` gives them (``near_time`` NULL), and the ticks within the tolerance of a window end with
    their number (``ticks``), all put out when the watermark has passed the pane they lie in."""
    marks = with_due_marks(ticks, params, params.zscore_tick_delay)
    first, last = window_ends_within(F.col("event_time"), params.tolerance, params.slide)
    asks = F.when((F.col("ahead") == 0) & (first <= last), F.array(F.lit(False), F.lit(True)))
    rows = marks.select("*", F.explode(F.coalesce(asks, F.array(F.lit(False)))).alias("near"))
    near = [F.when(F.col("near"), F.col(name)).alias(f"near_{of}") for name, of in (("event_time", "time"), ("price", "price"))]
    return (
        rows.select("*", *near)
        .groupBy(F.window("at", interval(params.slide)), "symbol", "near_time", "near_price")
        .agg(*tick_moments())
        .select("symbol", grid_index(F.col("window.start"), params.slide).alias("pane"), "ticks", "n", "mean", "m2",
                "near_time", "near_price")
    )


def zscore_writer(ticks: DataFrame, params: TickParams, folder: str, sinks: list[Sink]) -> DataStreamWriter:
    """z-score records of a stream of ticks, handed to every sink as (rows, batch id).

    A tick's record is out once the pane it lies in has closed; the window ends next to it end there or before. Ticks
    may be ``zscore_tick_delay`` late. ``folder``, shared by the executors, keeps the closed panes that later windows
    reach back to. Whatever a repeated batch writes replaces what it wrote before.
    """
    if params.tolerance >= params.slide:
        raise ValueError("the tolerance must be shorter than the slide")
    store = ReleasedRows(ticks.sparkSession, folder, PANE_COLUMNS)
    longest = params.largest // params.slide

    def write_batch(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            before = store.reached(batch_id - 1)
            newest = rows.agg(F.max("pane")).first()[0]
            # The ends next to a tick are the two of its pane, so windows of the pane before are asked for as well.
            first = None if before is None else before + 1 - longest
            if newest is not None:
                panes = rows.filter(F.col("near_time").isNull()).drop("near_time", "near_price")
                keep_panes(store, panes, batch_id, longest)
                moments = window_moments(known_panes(store, first, longest), params)
                if before is not None:
                    moments = moments.filter(F.col("pane") >= before)
                asking = rows.filter(F.col("near_time").isNotNull()).select(
                    "symbol",
                    F.col("near_price").alias("price"),
                    F.col("near_time").alias("event_time"),
                    F.explode(F.sequence(F.lit(1), F.col("ticks"))).alias("copy"),
                )
                records = zscore(asking, as_array(stats_of_panes(moments, params), params), params)
                to_sinks(records, batch_id, sinks)
            store.finish(batch_id, before if newest is None else newest, None if first is None else first // longest)
        finally:
            rows.unpersist()

    return stream_panes_and_near_ticks(ticks, params).writeStream.foreachBatch(write_batch).outputMode("append")


def stream_zscore(ticks: DataFrame, moving: DataFrame, params: TickParams) -> DataFrame:
    """Join two streams, ticks and moving records (column ``timestamp`` with a watermark).

    The equi key (symbol, window end) spreads the join state of a busy symbol over its window ends; the time band lets
    Spark drop state on both sides. A record is out when both sides have arrived.
    """
    near = near_window_ends(
        ticks.withWatermark("event_time", interval(params.zscore_tick_delay)), params
    ).select(F.col("symbol").alias("tick_symbol"), "price", "event_time", "window_end")
    band = F.expr(f"INTERVAL {interval(params.tolerance)}")
    same_end = (
        (F.col("tick_symbol") == F.col("symbol"))
        & (F.col("window_end") == F.col("timestamp"))
        & (F.col("event_time") >= F.col("timestamp") - band)
        & (F.col("event_time") <= F.col("timestamp") + band)
    )
    return near.join(moving, same_end, "inner").select(
        F.col("event_time").alias("timestamp"), "symbol", window_zscores().alias("zscores")
    )


def stream_zscore_of_ticks(ticks: DataFrame, params: TickParams) -> DataFrame:
    """Moving statistics and z-scores in one query, without a topic in between.

    The statistics side allows ticks ``zscore_moving_delay`` of lateness here.
    """
    moving = as_array(
        stream_window_ends(ticks, replace(params, moving_delay=params.zscore_moving_delay)), params
    )
    return stream_zscore(ticks, moving, params)


def stream_zscore_of_records(ticks: DataFrame, moving_records: DataFrame, params: TickParams) -> DataFrame:
    """z-scores from moving records that arrive as a stream of their own."""
    moving = moving_records.withWatermark("timestamp", interval(params.zscore_moving_delay))
    return stream_zscore(ticks, moving, params)
