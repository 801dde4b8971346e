"""Durations of the analyses, kept together so that a whole set can be scaled at once."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import timedelta

# Window labels and lengths, slide, tolerance, horizon, slot and watermark delays.
WINDOW_LENGTHS = {
    "30s": timedelta(seconds=30),
    "1m": timedelta(minutes=1),
    "5m": timedelta(minutes=5),
    "15m": timedelta(minutes=15),
    "30m": timedelta(minutes=30),
    "1h": timedelta(hours=1),
}


def micros(duration: timedelta) -> int:
    return duration // timedelta(microseconds=1)


def interval(duration: timedelta) -> str:
    """The duration as Spark interval text, exact to the microsecond."""
    return f"{micros(duration)} microseconds"


@dataclass(frozen=True)
class TickParams:
    """One consistent set of durations.

    ``windows`` is ordered from the shortest to the longest; every length must be a multiple of ``slide``.
    """

    slide: timedelta = timedelta(seconds=10)
    windows: tuple[tuple[str, timedelta], ...] = tuple(WINDOW_LENGTHS.items())
    tolerance: timedelta = timedelta(milliseconds=100)
    horizon: timedelta = timedelta(seconds=20)
    slot: timedelta = timedelta(milliseconds=100)
    moving_delay: timedelta = timedelta(seconds=10)
    shortest_delay: timedelta = timedelta(seconds=10)
    zscore_tick_delay: timedelta = timedelta(minutes=1)
    zscore_moving_delay: timedelta = timedelta(seconds=30)

    def __post_init__(self) -> None:
        lengths = [length for _, length in self.windows]
        if lengths != sorted(set(lengths)):
            raise ValueError("windows must have distinct lengths, shortest first")
        for label, length in self.windows:
            if length <= timedelta(0) or length % self.slide:
                raise ValueError(f"window {label} is not a multiple of the slide")

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(label for label, _ in self.windows)

    def panes(self, label: str) -> int:
        """Length of a window counted in slides."""
        return dict(self.windows)[label] // self.slide

    @property
    def largest(self) -> timedelta:
        return self.windows[-1][1]

    def only(self, *labels: str) -> TickParams:
        return replace(self, windows=tuple(w for w in self.windows if w[0] in labels))

    def scaled(self, factor: int) -> TickParams:
        """Every duration times ``factor``; labels stay, so records keep their shape."""
        durations = {
            name: value * factor for name, value in vars(self).items() if isinstance(value, timedelta)
        }
        return replace(
            self, **durations, windows=tuple((label, length * factor) for label, length in self.windows)
        )


REFERENCE = TickParams()

# The test tables hold about one tick per 15 minutes and symbol: the same ratios, two minutes to the second.
SCALED = REFERENCE.scaled(120)
