"""Resampling towards a target distribution: n-gram weights held in an array, and a parallel sort for exact ranks.

Two passes over the texts: one counts hashed n-grams of the corpus and of the target, the other adds up each document's
gains. Perturbed by Gumbel noise from the document's id, the highest weights are a sample without replacement.

The sort is by regular sampling. Each task sorts its own rows, a run, and gives one key of every so many; equally spaced
keys of those are the splitters, between which no segment holds more than about twice its share. Rows go to their
segment and are merged there, and the sizes of the segments before give exact ranks. Segments that begin after the last
rank to be drawn need not be sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.llm.common import stored, texts

BUCKETS = 10_000
WIDTH = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: Most segments of the sort; the driver sees the square of their number in keys of rows, and their sizes.
MAX_SEGMENTS = 1_000
#: Words up to this length are joined to n-grams by table; longer ones one by one.
TABLE_LENGTHS = 64
#: Words whose checksum a Python worker remembers before it starts anew.
REMEMBERED = 400_000
#: Fixed value: bytes of words are 0-9, a-z and all beyond ASCII, once A-Z are in lower case; all others part them.
WORD_BYTES = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


@cache
def shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """What n further zero bytes make of a checksum, by n, place and value of each of its four bytes; and by n the
    checksum of a space before n of them.

    Checksums are linear: that of two strings is the first one's, shifted by the length of the second, xor the second's.
    """
    tables = np.zeros((TABLE_LENGTHS + 2, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << np.array([[0], [8], [16], [24]], np.uint32)
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    for n in range(1, len(tables)):
        tables[n] = step[tables[n - 1] & np.uint32(255)] ^ (tables[n - 1] >> np.uint32(8))
    flat = tables.reshape(-1)
    return flat, _shifted(flat, np.full(len(tables), zlib.crc32(b" "), np.int64), np.arange(len(tables)))


def _shifted(flat: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    base = sizes * 1024
    parts = [flat[base + 256 * k + ((sums >> 8 * k) & 255)] for k in range(4)]
    return (parts[0] ^ parts[1] ^ parts[2] ^ parts[3]).astype(np.int64)


class Checksums:
    """Checksums of all runs of 1 to ``width`` words joined by a space. Each word's own is remembered, with its length."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _new(self, word: bytes) -> int:
        found = self.known[word] = min(len(word), TABLE_LENGTHS + 1) << 32 | zlib.crc32(word)
        return found

    def features(self, words: list[bytes], width: int = WIDTH) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, new = self.known.get, self._new
        packed = np.array([known(word) or new(word) for word in words], np.int64)
        alone, sizes = packed & 0xFFFFFFFF, packed >> 32
        flat, spaces = shift_tables()
        spaced = alone ^ spaces[sizes]
        long = np.flatnonzero(sizes > TABLE_LENGTHS)
        found, so_far = [alone], alone
        for k in range(1, min(width, len(words))):
            so_far = _shifted(flat, so_far[:-1], np.minimum(sizes[k:] + 1, TABLE_LENGTHS + 1)) ^ spaced[k:]
            for at in long[long >= k].tolist():
                so_far[at - k] = zlib.crc32(b" ".join(words[at - k : at + 1]))
            found.append(so_far)
        return np.concatenate(found)


@cache
def checksums() -> Checksums:
    """One per Python worker."""
    return Checksums()


def feature_counts(rows: DataFrame, buckets: int = BUCKETS, width: int = WIDTH) -> np.ndarray:
    """How many features of the ``text`` column fall into each bucket. Each task gives a row per bucket at most, and the
    driver gets one row per bucket."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, table = np.zeros(buckets, np.int64), checksums()
        for batch in batches:
            for text in batch.column("text"):
                held += np.bincount(table.features(words_of(text.as_py()), width) % buckets, minlength=buckets)
        full = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(held[full])], ["bucket", "held"])

    found = rows.select(F.col("text").cast("binary").alias("text")).mapInArrow(each, "bucket long, held long")
    counts = np.zeros(buckets, np.int64)
    for bucket, held in found.groupBy("bucket").agg(F.sum("held").alias("held")).collect():
        counts[bucket] = held
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the smoothed ratio) of each bucket, target to corpus."""
    all_corpus, all_target, size = float(corpus.sum()), float(target.sum()), float(len(corpus))
    ratios = [
        ((t + 1) * (all_corpus + size)) / ((s + 1) * (all_target + size))
        for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())
    ]
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def noise(seed: int, doc_id: object) -> int:
    """Gumbel noise in thousandths, from the seed and the id (NULL: none) alone."""
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    uniform = (int(hashlib.sha256(key).hexdigest()[:8], 16) + 0.5) / 4294967296
    return math.floor(-1000 * math.log(-math.log(uniform)))


def weighted(rows: DataFrame, gains: np.ndarray, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of ``rows`` of doc_id and text."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = checksums()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = words_of(text.as_py())
                features = table.features(words, width)
                weight = int(gains[features % len(gains)].sum())
                out.append((len(words), len(features), weight, weight + noise(seed, doc_id)))
            columns = [pa.array(column, pa.int64()) for column in zip(*out)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight", "score"]
            )

    rows = rows.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(each, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def _key(score: int, doc_id: object, row: int) -> tuple:
    """Keys rise as ranks do: high scores first, then small ids, NULL last; the row's own number parts repeated rows."""
    return (-score, doc_id is None, 0 if doc_id is None else doc_id, row)


def splitters(rows: DataFrame, segments: int, n_rows: int) -> list[tuple]:
    """Up to ``segments`` - 1 keys that part ``rows`` (score, doc_id, row) into segments of less than about twice their
    share: every run gives the last key of each stretch of n_rows / segments² rows."""
    step = max(1, n_rows // segments**2)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            first = (step - 1 - seen) % step
            seen += len(batch)
            yield batch.take(pa.array(np.arange(first, len(batch), step)))

    keys = rows.select("score", "doc_id", "row")
    runs = keys.sortWithinPartitions(*_in_order())
    samples = sorted(_key(*sample) for sample in runs.mapInArrow(each, keys.schema).collect())
    return [samples[len(samples) * k // segments] for k in range(1, segments)] if samples else []


def _in_order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]


def _with_segments(rows: DataFrame, parting: list[tuple]) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*(batch.column(name).to_pylist() for name in ("score", "doc_id", "row")))
            at = [bisect_right(parting, _key(*key)) for key in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*batch.schema.names, "segment"])

    fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(each, f"{fields}, segment int")


def ranked(rows: DataFrame, drawn: int, n_rows: int, segments: int | None = None) -> DataFrame:
    """``rows`` (doc_id, score, row and others) with ``rank``: 1, 2, 3 ... for the ``drawn`` highest scores, ties to the
    smaller id; NULL for the others. ``row`` differs in all rows."""
    spark = rows.sparkSession
    segments = segments or min(MAX_SEGMENTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = _with_segments(rows, splitters(rows, segments, n_rows))
    sizes = dict(dealt.groupBy("segment").count().collect())
    before, bases = 0, []
    for segment in sorted(sizes):
        if before < drawn:
            bases.append((segment, before))
        before += sizes[segment]
    columns = [F.col(name) for name in rows.columns]
    if not bases:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    base = spark.createDataFrame(bases, "segment int, base long")
    last = bases[-1][0]
    inside = F.row_number().over(Window.partitionBy("segment").orderBy(*_in_order())).cast("long")
    merged = dealt.filter(F.col("segment") <= last).withColumn("inside", inside)
    rank = F.col("base") + F.col("inside")
    # A row for each segment, MAX_SEGMENTS at most.
    first = merged.join(F.broadcast(base), "segment").select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    rest = dealt.filter(F.col("segment") > last).select(*columns, F.lit(None).cast("long").alias("rank"))
    return first.unionByName(rest)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    width: int = WIDTH,
    seed: int = SEED,
    segments: int | None = None,
) -> DataFrame:
    """Each document as doc_id, n_words, n_features, weight, score and rank; ``percent`` of the documents with at least
    ``min_words`` words are drawn and have a rank, the others NULL.

    NULL texts count as empty: no features, weight 0. A NULL id has the noise of an empty one and comes last among equal
    scores. Repeated rows are documents like others, with equal scores and ranks next to each other. An empty target
    gives gains against even counts; an empty table gives no rows.
    """
    rows = texts(docs, id_col, text_col)
    corpus_counts = feature_counts(rows, buckets, width)
    target_counts = feature_counts(texts(target, target_text_col, target_text_col), buckets, width)
    scored = weighted(rows, bucket_gains(corpus_counts, target_counts), width, seed)
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()))
    long_enough = F.col("n_words") >= min_words
    n_rows = scored.filter(long_enough).count()
    first = ranked(scored.filter(long_enough), percent * n_rows // 100, n_rows, segments)
    rest = scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest).drop("row")
