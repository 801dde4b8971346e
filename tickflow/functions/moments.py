"""Mergeable first and second moments of the prices in a span of time.

The moments of a span are four columns: ticks (rows), n (prices that are not NULL), mean, and m2, the sum of squared
deviations from the mean. Merging works on differences of means (Chan et al.), so equal prices give m2 = 0 exactly and
large prices with a small spread keep their digits, which differences of running sums would not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _if_equal(price: Column, value: Column, otherwise: Column) -> Column:
    return F.when(F.min(price) == F.max(price), value).otherwise(otherwise)


def exact_avg(price: Column) -> Column:
    """``avg``; for equal prices that price itself, which their sum divided by their number need not be."""
    return _if_equal(price, F.min(price), F.avg(price))


def exact_stddev(price: Column) -> Column:
    """``stddev``; for two or more equal prices exactly 0, where merged partial results leave a trace of rounding."""
    deviation = F.stddev_samp(price)
    return _if_equal(price, deviation * 0.0, deviation)


def price_moments(price: Column) -> list[Column]:
    """Aggregates whose partial results Spark combines before the shuffle."""
    n = F.count(price)
    return [
        F.count(F.lit(1)).alias("ticks"),
        n.alias("n"),
        exact_avg(price).alias("mean"),
        _if_equal(price, F.lit(0.0), F.var_pop(price) * n).alias("m2"),
    ]


@dataclass(frozen=True)
class Span:
    """SQL text for the moments of one span; mean and m2 count only where n > 0."""

    n: str
    mean: str
    m2: str


def merged_n(spans: list[Span]) -> str:
    return " + ".join(s.n for s in spans)


def merged_mean(spans: list[Span]) -> str:
    """Mean of all spans, computed around the mean of the first that is not empty; NULL if all are empty."""
    base = "coalesce(" + ", ".join(f"IF({s.n} > 0, {s.mean}, NULL)" for s in spans) + ")"
    shift = " + ".join(f"IF({s.n} > 0, ({s.mean} - {base}) * {s.n}, 0D)" for s in spans)
    return f"{base} + ({shift}) / nullif({merged_n(spans)}, 0)"


def merged_m2(spans: list[Span], mean: str) -> str:
    """Sum of squared deviations of all spans around their common ``mean``."""
    return " + ".join(
        f"IF({s.n} > 0, {s.m2} + {s.n} * ({s.mean} - {mean}) * ({s.mean} - {mean}), 0D)" for s in spans
    )


def sample_stddev(n: str, m2: str) -> str:
    """NULL below two prices, like ``stddev``."""
    return f"IF({n} > 1, sqrt({m2} / ({n} - 1)), NULL)"
