"""Time as whole microseconds since the epoch, and grids over it.

Integer arithmetic keeps slot borders exact and does not depend on the session time zone.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickflow.plans.params import micros


def floor_div(value: Column, step: int) -> Column:
    """Integer division rounding down, also before the epoch."""
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step))


def grid_index(event_time: Column, step: timedelta) -> Column:
    """Number of the grid cell [index * step, (index + 1) * step) that holds the instant."""
    return floor_div(F.unix_micros(event_time), micros(step))


def grid_time(index: Column, step: timedelta) -> Column:
    """Start of a grid cell as TIMESTAMP."""
    return F.timestamp_micros(index * F.lit(micros(step)))


def floor_time(event_time: Column, step: timedelta) -> Column:
    return grid_time(grid_index(event_time, step), step)


def naive_utc(event_time: Column) -> Column:
    """The UTC wall clock of an instant as TIMESTAMP_NTZ, whatever the session time zone is."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.unix_micros(event_time) * F.expr("INTERVAL '0.000001' SECOND")


def window_ends_within(event_time: Column, tolerance: timedelta, slide: timedelta) -> tuple[Column, Column]:
    """First and last grid point within ``tolerance`` of the instant, both inclusive (first > last: none)."""
    us, tol, step = F.unix_micros(event_time), micros(tolerance), micros(slide)
    return -floor_div(F.lit(tol) - us, step), floor_div(us + F.lit(tol), step)
