"""z-scores of the ticks next to window ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.timegrid import grid_time, window_ends_within
from tickflow.plans.params import TickParams


def near_window_ends(ticks: DataFrame, params: TickParams) -> DataFrame:
    """Ticks within ``tolerance`` of a window end, one row per such end (column ``window_end``).

    All other ticks are dropped here, before any shuffle.
    """
    first, last = window_ends_within(F.col("event_time"), params.tolerance, params.slide)
    return (
        ticks.withColumns({"first_end": first, "last_end": last})
        .filter(F.col("first_end") <= F.col("last_end"))
        .select(
            "symbol",
            "price",
            "event_time",
            F.explode(F.sequence("first_end", "last_end")).alias("end_index"),
        )
        .select("symbol", "price", "event_time", grid_time(F.col("end_index"), params.slide).alias("window_end"))
    )


def zscore(ticks: DataFrame, moving: DataFrame, params: TickParams) -> DataFrame:
    """Join ticks to the moving statistics whose window end lies within ±``tolerance`` of the tick.

    The band join becomes an equi-join on (symbol, window end): the ends next to a tick are known from the slide, so
    no task ever sees all ticks or all windows of a symbol, and each key has one row on the statistics side.
    """
    near = near_window_ends(ticks, params)
    ends = moving.select("symbol", F.col("timestamp").alias("window_end"), "windows")
    return near.join(ends, ["symbol", "window_end"], "inner").select(
        F.col("event_time").alias("timestamp"), "symbol", window_zscores().alias("zscores")
    )


def window_zscores() -> Column:
    """(price - average) / deviation per element of ``windows``; NULL where the deviation is 0 or NULL."""
    return F.transform(
        "windows",
        lambda w: F.struct(
            w["window"].alias("window"),
            F.try_divide(F.col("price") - w["avg_price"], w["std_price"]).alias("zscore_price"),
        ),
    )


def flag_outliers(zscores_by_window: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Mark z-scores beyond ±``threshold``; NULL stays NULL."""
    return zscores_by_window.withColumn("is_outlier", F.abs("zscore_price") > F.lit(threshold))
