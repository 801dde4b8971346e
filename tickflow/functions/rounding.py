"""Rounding that two engines agree on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Averages of cent prices over 2^k ticks end exactly half-way between two rounded values, where the order of the
# additions would decide the digit. The shift moves them off it (and turns a -0.0 into 0.0).
HALF_WAY_SHIFT = 1e-9


def steady_round(value: Column, digits: int) -> Column:
    return F.round(value + F.lit(HALF_WAY_SHIFT), digits)
