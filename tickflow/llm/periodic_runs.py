"""Runs of repeating words: recursive splitting at words too rare to take part, then a scan of lags in what is left.

In a run of ``exponent`` periods or more every word occurs that often, so a word that occurs less often in a stretch of
text is in no run that lies in the stretch, and cuts it. The parts are looked at again on their own, where words are
rarer still, until nothing changes. Nearly all prose is gone by then.

What survives is scanned for each lag q. A run holds (exponent - 1) * q places in a row that equal the place q further
on, so among the places 0, q, 2q, ... as many successive ones do: m / q comparisons for a lag and m log m for all of
them. Only there the run is followed to both sides.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import texts

EXPONENT = 4
SHORTEST = 6
RUNS = "runs array<struct<start:long,length:long,period:long>>"


def surviving(codes: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """The stretches (start, stop) in which every word occurs ``exponent`` times, found by splitting again and again.

    A round looks at the parts of all stretches that the last one cut; stretches that stay whole are done.
    """
    if len(codes) < shortest:
        return []
    words = int(codes.max()) + 1
    left = np.flatnonzero(np.bincount(codes, minlength=words)[codes] >= exponent)
    done = []
    while len(left):
        part = np.cumsum(np.diff(left, prepend=left[0]) > 1)
        sizes = np.bincount(part)
        _, at, counts = np.unique(part * words + codes[left], return_inverse=True, return_counts=True)
        stays = (counts[at] >= exponent) & (sizes[part] >= shortest)
        whole = np.bincount(part, ~stays) == 0
        starts = np.cumsum(sizes) - sizes
        done += [(int(left[starts[p]]), int(left[starts[p]] + sizes[p])) for p in np.flatnonzero(whole)]
        left = left[stays & ~whole[part]]
    return sorted(done)


def _equal_until(a: np.ndarray, b: np.ndarray) -> int:
    """The number of places from the first on at which the two are equal."""
    at, step, size = 0, 32, min(len(a), len(b))
    while at < size:
        unequal = np.flatnonzero(a[at : min(at + step, size)] != b[at : min(at + step, size)])
        if len(unequal):
            return at + int(unequal[0])
        at, step = at + step, 2 * step
    return size


def lag_scan(codes: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of one stretch.

    Lags rise, so a stretch of equal places that lies in a run of a divisor of the lag is that run once more and is
    passed over unread: the period found is the smallest one.
    """
    size, back = len(codes), codes[::-1]
    known: dict[int, tuple[list[int], list[int]]] = {}
    for lag in range(1, size // exponent + 1):
        grid = codes[::lag]
        equal = grid[1:] == grid[:-1]
        hits = equal[: len(equal) - exponent + 2].copy()
        for k in range(1, exponent - 1):
            hits &= equal[k : len(hits) + k]
        if not hits.any():
            continue
        divisors = [known[d] for d in known if lag % d == 0]
        until = 0
        for at in (np.flatnonzero(hits) * lag).tolist():
            if at < until:
                continue
            for starts, stops in divisors:
                k = bisect_right(starts, at) - 1
                if k >= 0 and at + lag < stops[k]:
                    until = stops[k] - lag
                    break
            else:
                stop = at + _equal_until(codes[at:], codes[at + lag :])
                start = at - _equal_until(back[size - at :], back[size - at - lag :])
                until = stop
                if stop + lag - start >= max(shortest, exponent * lag):
                    starts, stops = known.setdefault(lag, ([], []))
                    starts.append(start)
                    stops.append(stop + lag)
    return [(s, e - s, lag) for lag, (starts, stops) in known.items() for s, e in zip(starts, stops)]


def runs_of(words: list, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period), by start and period."""
    numbers: dict = {}
    codes = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    found = []
    for start, stop in surviving(codes, exponent, shortest):
        found += [(start + at, size, lag) for at, size, lag in lag_scan(codes[start:stop], exponent, shortest)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that lie in a run after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, size, period in runs:
        kept[start + period : start + size] = False
    return [words[at] for at in np.flatnonzero(kept).tolist()]


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    exponent: int = EXPONENT,
    shortest: int = SHORTEST,
    part_bytes: int = 4 << 20,
) -> DataFrame:
    """Each document as doc_id, n_words, runs (start, length, period; in words, by start and period) and collapsed, its
    words (split at the six ASCII spaces) with each run cut down to its first period, joined by single spaces.

    A run has a length of at least ``exponent`` times its smallest period and ``shortest`` words, and is as long as its
    period allows. NULL texts count as empty and have no runs. Repeated rows and NULL ids come out as they come in; an
    empty table gives no rows; bytes that are not UTF-8 come out as U+FFFD. Batches are handed on in parts of about ``part_bytes``, whole documents each.
    """
    if exponent < 3 or shortest < 1:
        raise ValueError("runs need an exponent of at least 3 and a length of at least 1")
    rows = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    types = [pa.int64(), pa.list_(run), pa.string()]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, first, size = [], 0, 0
            for at, text in enumerate(batch.column("text"), 1):
                words = text.as_py().split()
                runs = runs_of(words, exponent, shortest)
                left = b" ".join(collapsed(words, runs)).decode("utf-8", "replace")
                out.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], left))
                size += len(left)
                if size > part_bytes or at == len(batch):
                    columns = [pa.array(column, of) for column, of in zip(zip(*out), types)]
                    keys = batch.column("doc_id").slice(first, at - first)
                    yield pa.RecordBatch.from_arrays([keys, *columns], ["doc_id", "n_words", "runs", "collapsed"])
                    out, first, size = [], at, 0

    return rows.mapInArrow(each, f"doc_id {kind}, n_words long, {RUNS}, collapsed string")
