"""Repeated passages: strings of a given length that also start in an earlier document, removed byte by byte.

Not by the sort that a difference cover of residues asks for, see the README: here the cover is chosen by content. In
each window of ``length`` bytes the 24 bytes of the smallest hash are its sample, about one position in 14, so equal
windows have their sample at the same offset. A sample stands for a stretch of successive windows; the bytes of all of
them are its context.

1. Samples are combined by key, and those that one text alone holds go: their windows are in no other text. A filter of
   bounded size says which are left; the others that it lets through change nothing but the work.
2. Equal contexts are one, named by a hash besides the key, with the smallest document that holds it.
3. Each text is brought together with the names it is the first to hold, once. Where it holds a context of another
   document's, the whole context is repeated.
4. Windows of different contexts of one key are compared by their bytes, in the first document of each: there a context
   loses the windows that a still earlier document holds in another context.

All are aggregations that Spark combines before the shuffle and joins that it can split, so that a passage which a third
of all documents share is never in one task's hands. What a context that many documents hold takes on disk is one row for
the name, and its part of the merged spans; where it stands is found anew from the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickflow.llm.common import fresh, named, stored, texts

LENGTH = 50
#: Bytes of a sample. Shorter ones are fewer, but more of them stand in texts that have no window in common.
GRAM = 24
SPANS = "spans array<struct<start:int,stop:int>>"
#: Up to so many copies or spans are sent to all tasks; more are joined by a shuffle.
ROWS_SENT = 8_000_000
#: The filter of shared keys has at most so many bits (128 MB), in segments of SEGMENT bits, and sets PROBES for a key.
FILTER_BITS = 1 << 30
SEGMENT = 1 << 16
PROBES = 4
#: Up to so many contexts of a key are compared in one task; the windows of keys with more are shuffled one by one.
TOGETHER = 10_000


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def samples(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, positions, firsts): each sampled position with the 48-bit hash of its bytes, and the first of the windows it
    stands for, which end before the next sample's first one. A window's sample is the leftmost of the smallest
    (32-bit) hashes in it."""
    if len(text) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed = (np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    power = np.array([0x9E3779B97F4A7C15], np.uint64)
    size = 1
    while size < 8:
        hashed = hashed[:-size] * power + hashed[size:]
        power = power * power
        size *= 2
    eights, count = hashed, len(text) - GRAM + 1
    hashed = eights[:count]
    for at in range(8, GRAM, 8):
        hashed = hashed * power + eights[at : at + count]
    hashed ^= hashed >> np.uint64(31)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed ^= hashed >> np.uint64(29)
    placed = (hashed >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashed), dtype=np.uint64)
    chosen = (_sliding_least(placed, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    firsts = np.flatnonzero(np.diff(chosen, prepend=-1))
    at = chosen[firsts]
    return hashed[at] >> np.uint64(16), at, firsts


def _keys(length: int):
    """The keys of each text, each once."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 500):
                some = batch.column("text").slice(low, 500)
                found = [np.unique(samples(text.as_py(), length)[0]) for text in some]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["key"])

    return each


def _probes(keys: np.ndarray, segments: int, segment: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The segment of each key, and its bits in there; both counts are powers of two."""
    mixed = keys * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    first, step = mixed & np.uint64(0xFFFF), mixed >> np.uint64(16) & np.uint64(0xFFFF) | np.uint64(1)
    bits = [(first + np.uint64(n) * step & np.uint64(segment - 1)).astype(np.int64) for n in range(PROBES)]
    return (mixed >> np.uint64(32) & np.uint64(segments - 1)).astype(np.int64), bits


def _segments_of(segments: int, segment: int):
    """Keys with their segment of the filter."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            at = _probes(keys.to_numpy().view(np.uint64), segments, segment)[0]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), keys], ["segment", "key"])

    return each


def _filled(segments: int, segment: int):
    """The bits of each segment whose keys these are, as one row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            at, bits = _probes(batch.column("key").to_numpy().view(np.uint64), segments, segment)
            for n in np.unique(at).tolist():
                row = found.setdefault(n, np.zeros(segment, np.bool_))
                for places in bits:
                    row[places[at == n]] = True
        for n, row in found.items():
            packed = np.packbits(row, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([packed], pa.binary())], ["segment", "bits"])

    return each


def _holds(bits: np.ndarray, segment: int, keys: np.ndarray) -> np.ndarray:
    """Which of the keys the filter lets through: all that were put in, and a few others."""
    at, places = _probes(keys, len(bits) * 8 // segment, segment)
    held = np.ones(len(keys), np.bool_)
    for place in places:
        place = place + at * segment
        held &= (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(np.bool_)
    return held


def _key_filter(shared: DataFrame, most_bits: int, segment: int) -> np.ndarray:
    """A Bloom filter of the keys, 8 bits and more for each as long as that is not above ``most_bits``."""
    segments = max(1, min(most_bits, 1 << (8 * shared.count()).bit_length()) // segment)
    placed = shared.mapInArrow(_segments_of(segments, segment), "segment int, key long").repartition("segment")
    rows = placed.mapInArrow(_filled(segments, segment), "segment int, bits binary").toArrow()
    bits = np.zeros((segments, segment // 8), np.uint8)
    for n, row in zip(rows["segment"].to_pylist(), rows["bits"]):
        bits[n] = np.frombuffer(row.as_buffer(), np.uint8)
    return bits.reshape(-1)


def _contexts(some: pa.RecordBatch, length: int, bits: np.ndarray, segment: int) -> list[tuple]:
    """Of each text: key, name, start and stop of the contexts whose key the filter lets through, as lists."""
    raw = [text.as_py() for text in some.column("text")]
    found = [samples(text, length) for text in raw]
    held = _holds(bits, segment, np.concatenate([keys for keys, _, _ in found]))
    out, low = [], 0
    for text, (keys, _, firsts) in zip(raw, found):
        chosen = held[low : low + len(keys)]
        low += len(keys)
        stops = np.append(firsts[1:], len(text) - length + 1) + (length - 1)
        starts, stops = firsts[chosen].tolist(), stops[chosen].tolist()
        names = np.array([xxhash.xxh64_intdigest(text[a:b]) for a, b in zip(starts, stops)], np.uint64)
        out.append((text, keys[chosen].view(np.int64), names.view(np.int64), starts, stops))
    return out


def _names(length: int, wanted, segment: int):
    """Names of contexts with a wanted key: key, name, doc_id."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 200):
                some = batch.slice(low, 200)
                found = _contexts(some, length, wanted.value, segment)
                owner = np.repeat(np.arange(len(found)), [len(keys) for _, keys, *_ in found])
                columns = [np.concatenate([f[n] for f in found]) for n in (1, 2)]
                ids = some.column("doc_id").take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), ids], ["key", "name", "doc_id"])

    return each


#: What a text does with a context: it is repeated (REPEATED), or the text is the first to hold it, and its key has no other
#: (ALONE), or others to be compared within a task (TOGETHER at most) or window by window.
REPEATED, ALONE, IN_TASK, BY_WINDOW = range(4)


def _placed(length: int, wanted, segment: int):
    """Texts with the names they are the first to hold (``owned``): doc_id, text_id, kind, key, start, stop and bytes of
    the contexts that are to be compared; and what is made of repeated contexts, merged."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 200):
                some = batch.slice(low, 200)
                owner, out = [], []
                for n, (text, keys, names, starts, stops) in enumerate(_contexts(some, length, wanted.value, segment)):
                    own = some.column("owned")[n].values
                    kinds = {} if own is None else dict(zip(own.field("name").to_pylist(), own.field("kind").to_pylist()))
                    before, runs = len(out), []
                    for key, name, start, stop in zip(keys.tolist(), names.tolist(), starts, stops):
                        kind = kinds.get(name, REPEATED)
                        if kind >= IN_TASK:
                            out.append((kind, key, start, stop, text[start:stop]))
                        elif kind == REPEATED and runs and start <= runs[-1][1]:
                            runs[-1][1] = stop
                        elif kind == REPEATED:
                            runs.append([start, stop])
                    out += [(REPEATED, None, start, stop, None) for start, stop in runs]
                    owner += [n] * (len(out) - before)
                if out:
                    types = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                    columns = [pa.array(column, kind) for column, kind in zip(zip(*out), types)]
                    ids = [some.column(name).take(pa.array(owner)) for name in ("doc_id", "text_id")]
                    names = ["doc_id", "text_id", "kind", "key", "start", "stop", "context"]
                    yield pa.RecordBatch.from_arrays([*ids, *columns], names)

    return each


def shared_keys(rows: DataFrame, length: int) -> DataFrame:
    """The keys of several texts."""
    held = rows.select("text").mapInArrow(_keys(length), "key long").groupBy("key").agg(F.count(F.lit(1)).alias("number"))
    return stored(held.filter("number > 1").select("key"))


def _compared(length: int):
    """Rows sorted by key: of each context the windows that a smaller document has in another one, in runs."""

    def earlier(rows: list) -> Iterator[tuple]:
        if len({context for *_, context in rows}) < 2:
            return
        windows = sorted((c[at : at + length], doc_id) for doc_id, _, _, c in rows for at in range(len(c) - length + 1))
        least = {}
        for before, (window, doc_id) in zip([(None, None), *windows], windows):
            if window != before[0]:  # neighbours differ: the first of equal windows is the smallest document's
                least[window] = doc_id
        for doc_id, text_id, start, context in rows:
            run, count = None, len(context) - length + 1
            for at in range(count + 1):
                repeated = at < count and least[context[at : at + length]] < doc_id
                if repeated and run is None:
                    run = at
                elif not repeated and run is not None:
                    yield doc_id, text_id, start + run, start + at - 1 + length
                    run = None

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, kinds = None, [], None

        def batch_of(found: list) -> pa.RecordBatch:
            columns = [pa.array(column, kind) for column, kind in zip(zip(*found), kinds)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_id", "start", "stop"])

        for batch in batches:
            kinds = (batch.schema.field("doc_id").type, pa.int64(), pa.int32(), pa.int32())
            out: list[tuple] = []
            columns = (batch.column(name).to_pylist() for name in ("key", "doc_id", "text_id", "start", "context"))
            for row_key, *row in zip(*columns):
                if row_key != key:
                    out += earlier(rows)
                    key, rows = row_key, []
                rows.append(row)
            if out:
                yield batch_of(out)
        if found := list(earlier(rows)):
            yield batch_of(found)

    return each


def _windows(length: int):
    """The windows of contexts one by one: doc_id, text_id, start, window."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 2_000):
                some = batch.slice(low, 2_000)
                owner, starts, windows = [], [], []
                for n, (start, context) in enumerate(zip(some.column("start").to_pylist(), some.column("context").to_pylist())):
                    count = len(context) - length + 1
                    owner += [n] * count
                    starts += range(start, start + count)
                    windows += [context[at : at + length] for at in range(count)]
                ids = [some.column(name).take(pa.array(owner, pa.int64())) for name in ("doc_id", "text_id")]
                columns = [*ids, pa.array(starts, pa.int32()), pa.array(windows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_id", "start", "window"])

    return each


def repeated_stretches(rows: DataFrame, length: int, together: int, most_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, text_id, start, stop of what is repeated in ``rows`` (doc_id, text_id, text), as they overlap."""
    spark = rows.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()
    span = ["doc_id", "text_id", "start", "stop"]
    rows = rows.select("doc_id", "text_id", "text")
    segment = min(SEGMENT, most_bits)
    wanted = spark.sparkContext.broadcast(_key_filter(shared_keys(rows, length), most_bits, segment))

    names = rows.select("doc_id", "text").mapInArrow(_names(length, wanted, segment), f"key long, name long, doc_id {kind}")
    once = stored(names.groupBy("key", "name").agg(F.min("doc_id").alias("first")))
    several = once.groupBy("key").agg(F.count(F.lit(1)).alias("number")).filter("number > 1")
    way = F.when(F.col("number").isNull(), ALONE).when(F.col("number") <= together, IN_TASK).otherwise(BY_WINDOW)
    owned = once.join(several, "key", "left").select(F.col("first").alias("doc_id"), "name", way.alias("kind"))
    owned = owned.repartition("doc_id").groupBy("doc_id").agg(F.collect_list(F.struct("name", "kind")).alias("owned"))

    schema = f"doc_id {kind}, text_id long, kind int, key long, start int, stop int, context binary"
    with_owned = rows.join(owned, "doc_id", "left").select("doc_id", "text_id", "text", "owned")
    placed = stored(with_owned.mapInArrow(_placed(length, wanted, segment), schema))
    later = placed.filter(F.col("kind") == REPEATED)
    in_task = placed.filter(F.col("kind") == IN_TASK).select("key", "doc_id", "text_id", "start", "context")
    in_task = in_task.repartition("key").sortWithinPartitions("key")
    own = in_task.mapInArrow(_compared(length), f"doc_id {kind}, text_id long, start int, stop int")
    many = placed.filter(F.col("kind") == BY_WINDOW).select("doc_id", "text_id", "start", "context")
    found = later.select(span).unionByName(own)
    if many.isEmpty():
        return found
    windows = many.mapInArrow(_windows(length), f"doc_id {kind}, text_id long, start int, window binary")
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"))
    beyond = windows.join(least, "window").filter("least < doc_id")
    beyond = beyond.select("doc_id", "text_id", "start", (F.col("start") + length).alias("stop"))
    return found.unionByName(beyond)


def _merged(spans: DataFrame) -> DataFrame:
    """doc_id, text_id, spans: overlapping and touching spans (start, stop) as one, in order."""
    in_order = Window.partitionBy("doc_id", "text_id").orderBy("start", "stop")
    reached = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > reached, F.lit(True)).cast("int")
    rows = spans.withColumn("opens", opens).withColumn("run", F.sum("opens").over(in_order))
    runs = rows.groupBy("doc_id", "text_id", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    listed = F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans")
    return runs.groupBy("doc_id", "text_id").agg(listed)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            text = text.as_py()
            runs = [(span["start"], span["stop"]) for span in spans.as_py() or []]
            at, parts = 0, []
            for start, stop in runs:
                parts.append(text[at:start])
                at = stop
            parts.append(text[at:])
            kept = b"".join(parts)
            spans = [{"start": start, "stop": stop} for start, stop in runs]
            rows.append((len(text), len(text) - len(kept), len(runs), spans, hashlib.sha256(kept).hexdigest()))
        span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
        types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(span), pa.string())
        arrays = [pa.array([row[n] for row in rows], kind) for n, kind in enumerate(types)]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    rows_sent: int = ROWS_SENT,
    together: int = TOGETHER,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Each document with what is removed: doc_id, n_bytes, n_removed, n_spans, spans (start, stop), kept_sha256.

    A byte is removed if a string of ``length`` bytes over it also starts in a document of a smaller id. Equal texts
    are one from the start: the copies after the first are removed whole and take no further part.

    NULL texts count as empty. Ids order the documents; a document of NULL id is left as it is and is no earlier
    document for others. Rows of one id are one document as far as others look at it: none is earlier than another.
    Repeated rows come out as they come in. An empty table gives no rows.
    """
    rows, spans = _rows_and_spans(docs, id_col, text_col, length, rows_sent, together, filter_bits)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, {SPANS}, kept_sha256 string"
    return rows.join(spans, ["doc_id", "text_id"], "left").select("doc_id", "text", "spans").mapInArrow(_kept, schema)


def _rows_and_spans(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    length: int,
    rows_sent: int = ROWS_SENT,
    together: int = TOGETHER,
    filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Documents as doc_id, text_id, text (bytes); and by doc_id and text_id the spans to remove."""
    rows = texts(docs, id_col, text_col).withColumn("text_id", F.xxhash64("text"))
    rows = rows.withColumn("text", F.col("text").cast("binary"))
    known = rows.filter("doc_id IS NOT NULL")
    sizes = known.select("doc_id", "text_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.length("text").alias("size"))
    sizes = sizes.filter(F.col("size") >= length)
    firsts = stored(sizes.groupBy("digest").agg(F.min("doc_id").alias("first")))
    copies = stored(sizes.join(firsts, "digest").filter("first < doc_id").select("doc_id", "text_id", "size").distinct())
    whole = copies.select("doc_id", "text_id", F.lit(0).alias("start"), F.col("size").alias("stop"))
    sent = F.broadcast(copies) if copies.count() <= rows_sent else copies
    first_texts = known.join(sent, ["doc_id", "text_id"], "left_anti")
    spans = repeated_stretches(first_texts, length, together, filter_bits).unionByName(whole)
    spans = stored(_merged(spans))
    few = (spans.agg(F.sum(F.size("spans"))).first()[0] or 0) <= rows_sent
    return rows, F.broadcast(spans) if few else spans


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents without repeated passages, with all their columns; ``n_chars``, if there, counts anew.

    A character goes if all its bytes do, so texts stay valid; a document may be left empty. Rows of one id and different
    texts each lose their own passages.
    """
    spans_id, spans_text, runs = fresh(docs, "spans_id", "spans_text", "spans")
    spans = _rows_and_spans(docs, id_col, text_col, length)[1]
    spans = spans.select(F.col("doc_id").alias(spans_id), F.col("text_id").alias(spans_text), F.col("spans").alias(runs))
    text = F.coalesce(named(text_col), F.lit(""))
    joined = docs.join(spans, (named(id_col) == F.col(spans_id)) & (F.xxhash64(text) == F.col(spans_text)), "left")
    left = F.when(F.col(runs).isNull(), named(text_col)).otherwise(_without_spans(named(text_col), F.col(runs)))
    counted = {"n_chars": F.length(F.coalesce(left, F.lit(""))).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return joined.withColumns({text_col: left, **counted}).select([named(c) for c in docs.columns])


@F.pandas_udf(T.StringType())
def _without_spans(text: pd.Series, spans: pd.Series) -> pd.Series:
    def cut(one: str, runs) -> str:
        raw, at, parts = one.encode(), 0, []
        for run in runs:
            start, stop = run["start"], run["stop"]
            while start < stop and raw[start] & 0xC0 == 0x80:  # begins inside a character: that one stays
                start += 1
            while stop > start and stop < len(raw) and raw[stop] & 0xC0 == 0x80:  # ends inside one: it stays, too
                stop -= 1
            parts.append(raw[at:start])
            at = stop
        return b"".join([*parts, raw[at:]]).decode("utf-8", "replace")

    return pd.Series([one if runs is None else cut(one or "", runs) for one, runs in zip(text, spans)], dtype=object)
