"""Packing of token sequences by minimum bin slack."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tickflow.llm.common import stored, texts

CAPACITY = 4096
END_OF_DOCUMENT = 2
#: Texts of these characters only need no more normalising than lower case before the vocabulary's own split.
LATIN_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ"
LATIN_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_PATTERN = (
    f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN_LETTERS}]+|[{LATIN_NUMBERS}]|[^\t-\r \x85\xa0{LATIN_LETTERS}{LATIN_NUMBERS}]+"
)
#: U+0130 becomes two characters in lower case, one of them beyond these.
BEYOND_LATIN = re.compile("[^\x00-įı-ſ]")
REMEMBERED = 400_000
#: Lengths are ranked in shares of about so many documents.
SHARE_DOCUMENTS = 20_000


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in the vocabulary: itself where it can be seen, else the next from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in seen)
    return {b: 256 + n for n, b in enumerate(hidden)}


class Ids:
    """Ids of the tokenizers library: distinct pieces of Latin text once each by its model, other texts whole.

    Pieces are remembered in two generations, so that frequent ones stay when memory is full.
    """

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(file, encoding="utf-8") as opened:
            self.special = [token["content"] for token in json.load(opened)["added_tokens"]]
        self.split = re.compile(LATIN_PATTERN).findall
        self.letters, self.tokenize = byte_letters(), self.tokenizer.model.tokenize
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _new(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            tokens = self.tokenize(piece.encode().decode("latin-1").translate(self.letters))
            found = b"".join([token.id.to_bytes(4, "little") for token in tokens])
        self.known[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if BEYOND_LATIN.search(text) or any(token in text for token in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, new = self.known.get, self._new
        return b"".join([known(piece) or new(piece) for piece in self.split(text.lower())])


@cache
def ids_of(file: str) -> Ids:
    """One per Python worker and file."""
    return Ids(file)


def pieces(docs: DataFrame, file: str, capacity: int = CAPACITY, end_id: int = END_OF_DOCUMENT) -> DataFrame:
    """Documents (doc_id, text) cut into pieces of the capacity and a rest: doc_id, row_id, start, length, ids, doc_tokens.

    ``row_id`` tells documents of one doc_id apart.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ids_of(file)
        for batch in batches:
            for low in range(0, len(batch), 200):  # a piece for each 16 KB of ids: small batches out
                some = batch.slice(low, 200)
                at, rows = [], []
                for n, text in enumerate(some.column("text")):
                    ids = coder.encode((text.as_py() or b"").decode("utf-8", "replace")) + end
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        at.append(n)
                        rows.append((start, min(capacity, total - start), ids[4 * start : 4 * (start + capacity)], total))
                columns = [pa.array(column, t) for column, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.int64()))]
                keys = [some.column("doc_id").take(pa.array(at)), some.column("row_id").take(pa.array(at))]
                yield pa.RecordBatch.from_arrays([*keys, *columns], ["doc_id", "row_id", "start", "length", "ids", "doc_tokens"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("row_id"), F.col("text").cast("binary").alias("text"))
    schema = f"doc_id {kind}, row_id long, start long, length long, ids binary, doc_tokens long"
    return rows.mapInArrow(each, schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, none more often than it is left, whose sum comes closest to ``room`` from below.

    A bitset holds the sums within reach after each length; the way back from the largest one gives how often each
    length is taken. It ends early where the room is filled exactly.
    """
    full = (1 << (room + 1)) - 1
    reach, trail = 1, []
    for length in sorted((k for k in counts if k <= room and counts[k]), reverse=True):
        most = min(counts[length], room // length)
        trail.append((length, reach))
        step, left = 1, most  # so many copies at once: 1, 2, 4, ... and the rest give every number up to the most
        while left:
            take = min(step, left)
            reach |= (reach << (take * length)) & full
            left -= take
            step *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(trail):
        taken = 0
        while not before >> at & 1:
            at -= length
            taken += 1
        if taken:
            chosen[length] = taken
    return chosen


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(how many sequences, lengths in each) for all rests: the longest left opens a sequence, the room is filled with
    the least slack, and the same filling repeats as long as the lengths last.

    Each filling uses up a length or lasts for less than one more repeat, so there are no more fillings than a small
    multiple of the capacity, whatever the number of documents.
    """
    counts = {length: n for length, n in counts.items() if n}
    found = []
    while counts:
        first = max(counts)
        counts[first] -= 1
        chosen = fullest(counts, capacity - first)
        counts[first] += 1
        chosen[first] = chosen.get(first, 0) + 1
        repeats = min(counts[length] // n for length, n in chosen.items())
        found.append((repeats, chosen))
        for length, n in chosen.items():
            counts[length] -= repeats * n
            if not counts[length]:
                del counts[length]
    return found


def slots(plan: list[tuple[int, dict[int, int]]]) -> list[tuple[int, ...]]:
    """(length, first rank, rank after the last, how many in each sequence, first sequence, offset of the first)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for repeats, chosen in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            first = used.get(length, 0)
            used[length] = first + repeats * chosen[length]
            rows.append((length, first, used[length], chosen[length], sequence, offset))
            offset += length * chosen[length]
        sequence += repeats
    return rows


SLOT = T.StructType([T.StructField(name, T.LongType()) for name in ("length", "low", "high", "each", "sequence", "first")])


def packed(
    docs: DataFrame,
    file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_OF_DOCUMENT,
    share_documents: int = SHARE_DOCUMENTS,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces with their place: doc_id, row_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids
    (little-endian unsigned 32-bit integers) unless they are not wanted.

    A document is cut only where it is longer than a sequence. Only the number of pieces of each length goes to the
    driver, at most ``capacity`` numbers; the fillings it finds are as bounded. Pieces of one length are numbered in
    shares by a hash of the document, so that a length which a third of all documents has is not sorted in one task;
    their number gives the place in a sequence.

    NULL texts count as empty: the end id alone. Repeated rows and NULL ids are documents like others. An empty table
    gives no rows.
    """
    cut = pieces(texts(docs, id_col, text_col), file, capacity, end_id).withColumn("ids_crc32", F.crc32("ids"))
    rows = stored(cut if with_ids else cut.drop("ids"))
    shares = rows.count() // share_documents + 1
    share = F.pmod(F.xxhash64("doc_id", "row_id", "start"), F.lit(shares)).alias("share")
    lengths = rows.select("*", share)
    held = stored(lengths.groupBy("length", "share").agg(F.count(F.lit(1)).alias("held")))
    counts = {r["length"]: r["held"] for r in held.groupBy("length").agg(F.sum("held").alias("held")).collect()}
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("length", "share", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))

    spark = docs.sparkSession
    places = spark.createDataFrame(slots(patterns(counts, capacity)), SLOT)
    place = F.struct("low", "high", "each", "sequence", "first")
    by_length = places.groupBy("length").agg(F.collect_list(place).alias("places"))
    inside = Window.partitionBy("length", "share").orderBy("doc_id", "row_id", "start")
    numbered = lengths.withColumn("number", F.row_number().over(inside) - 1).join(base, ["length", "share"])
    numbered = numbered.withColumn("rank", F.col("base") + F.col("number"))
    # At most one row per length.
    found = numbered.join(F.broadcast(by_length), "length").withColumn("place", _place(F.col("places"), F.col("rank")))
    nth = F.col("rank") - F.col("place.low")
    sequence = F.col("place.sequence") + F.floor(nth / F.col("place.each"))
    offset = F.col("place.first") + F.pmod(nth, F.col("place.each")) * F.col("length")
    return found.select(*rows.columns, sequence.cast("long").alias("sequence_id"), offset.alias("offset"))


def _place(places, rank):
    """The place whose ranks hold this one; each length has few."""
    return F.element_at(F.filter(places, lambda place: (place["low"] <= rank) & (rank < place["high"])), 1)
