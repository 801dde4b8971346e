"""Near duplicates by SimHash, found through Golay codewords."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import fresh, named, stored, texts

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42

#: Generator polynomial of the binary Golay code of 23 bits, and the bits of a fingerprint's segments.
GENERATOR = 0b101011100011
SEGMENTS = (22, 21, 21)
CODE_BITS, CHECK_BITS = 23, 11
#: Bits of a key: at most a whole segment, and 24 of codewords. Its kind stands above them.
KEY_BITS = 46


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """64 bits: each is set if it is set in over half of the hashes of the shingles, repeats included."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: -width] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(over).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fingerprint (a long) of ``docs`` of doc_id and text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), width) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))], ["doc_id", "fingerprint"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(each, f"doc_id {kind}, fingerprint long")


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of all 23-bit words; by syndrome: the lightest error pattern, and the five of weight 4 (0: none).

    The code is perfect: each syndrome belongs to exactly one pattern of weight 3 or less. A word at distance 3 from
    its codeword has five further codewords at distance 4; nearer words have none.
    """
    single = []
    for bit in range(CODE_BITS):
        rest = 1 << bit
        for high in range(bit, CHECK_BITS - 1, -1):
            if rest >> high & 1:
                rest ^= GENERATOR << (high - CHECK_BITS)
        single.append(rest)
    syndromes = np.zeros(1, np.int64)
    for bit in range(CODE_BITS):
        syndromes = np.concatenate([syndromes, syndromes ^ single[bit]])
    lightest, fours = np.zeros(1 << CHECK_BITS, np.int64), [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(1, 5):
        for bits in combinations(range(CODE_BITS), weight):
            pattern = sum(1 << bit for bit in bits)
            if weight < 4:
                lightest[syndromes[pattern]] = pattern
            else:
                fours[syndromes[pattern]].append(pattern)
    return syndromes, lightest, np.array([found or [0] * 5 for found in fours], np.int64)


def codewords(words: np.ndarray) -> np.ndarray:
    """Indices of all codewords within 4 bits of each 23-bit word, one or six per row; -1 fills up.

    Words that differ in at most two bits share one: the codeword within 3 bits of a word halfway between them.
    """
    syndromes, lightest, fours = golay_tables()
    at = syndromes[words]
    near = (words ^ lightest[at]) >> CHECK_BITS
    further = (words[:, None] ^ fours[at]) >> CHECK_BITS
    further[fours[at][:, 0] == 0] = -1
    return np.concatenate([near[:, None], further], axis=1)


def _masks() -> list[int]:
    masks, low = [], 0
    for bits in SEGMENTS:
        masks.append(((1 << bits) - 1) << low)
        low += bits
    return masks


def _pieces() -> list[int]:
    """The last segment in three."""
    bits = SEGMENTS[2] // 3
    return [((1 << bits) - 1) << (64 - SEGMENTS[2] + k * bits) for k in range(3)]


ORDERED_PAIRS = [(i, j) for i in range(3) for j in range(3) if i != j]


def print_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of fingerprints (unsigned): (positions, kinds, keys). Fingerprints within 4 bits share a key.

    Four errors over three segments leave either a segment without any, and then another with two at most: kinds 0 to 5
    join one segment as it is and a codeword of another. Or each segment has one or two: kinds 6 to 8 join codewords of
    the first two segments and a third of the last one, of which two errors leave one untouched.
    """
    lows = np.cumsum((0, *SEGMENTS[:2])).tolist()
    parts = [((prints >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64) for low, bits in zip(lows, SEGMENTS)]
    near = [codewords(part) for part in parts]
    at, kinds, keys = [], [], []

    def add(kind: int, exact: np.ndarray, codes: np.ndarray) -> None:
        rows, columns = np.nonzero(codes >= 0)
        at.append(rows)
        kinds.append(np.full(len(rows), kind, np.int32))
        keys.append(exact[rows] << 24 | codes[rows, columns])

    for kind, (i, j) in enumerate(ORDERED_PAIRS):
        add(kind, parts[i], near[j])
    both = near[0][:, :, None] << 12 | near[1][:, None, :]
    both[(near[0] < 0)[:, :, None] | (near[1] < 0)[:, None, :]] = -1
    both = both.reshape(len(prints), -1)
    for kind, mask in enumerate(_pieces(), 6):
        piece = (prints & np.uint64(mask)) >> np.uint64((mask & -mask).bit_length() - 1)
        add(kind, piece.astype(np.int64), both)
    return np.concatenate(at), np.concatenate(kinds), np.concatenate(keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, carried = (batch.column(name).to_numpy() for name in ("fingerprint", "carried"))
        for start in range(0, len(prints), 2_000):
            at, kinds, keys = print_keys(prints[start : start + 2_000].view(np.uint64))
            columns = [pa.array(kinds.astype(np.int64) << KEY_BITS | keys), pa.array(carried[start + at])]
            yield pa.RecordBatch.from_arrays(columns, ["key", "carried"])


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _first_kind(a: str, b: str):
    """The first kind of key that two fingerprints within 4 bits must share: so only that one yields the pair."""
    differing = F.col(a).bitwiseXOR(F.col(b))
    errors = [F.bit_count(differing.bitwiseAND(F.lit(_signed(mask)))) for mask in _masks()]
    kind = None
    for number, (i, j) in enumerate(ORDERED_PAIRS):
        covered = (errors[i] == 0) & (errors[j] <= 2)
        kind = F.when(covered, number) if kind is None else kind.when(covered, number)
    for number, mask in enumerate(_pieces(), 6):
        kind = kind.when(differing.bitwiseAND(F.lit(_signed(mask))) == 0, number)
    return kind


def _keys_of(prints: DataFrame, carried: str = "fingerprint") -> DataFrame:
    """key (with its kind) of each ``fingerprint``, and a long column ``carried``; made in many tasks, as each
    fingerprint has over a hundred keys."""
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = prints.select("fingerprint", F.col(carried).alias("carried")).repartition(tasks, "fingerprint")
    return rows.mapInArrow(_keyed, "key long, carried long").withColumnRenamed("carried", carried)


def _shuffled(rows: DataFrame) -> DataFrame:
    """``rows``, to be joined by a shuffle: those of keys, and those that hold every fingerprint. Spark sizes keys by the
    fingerprints they are made from, without the many keys of each, and fingerprints by their packed files, and would
    gather tables above its limit on the driver to send them to all tasks."""
    return rows.hint("merge")


def _close(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def near_pairs(prints: DataFrame) -> DataFrame:
    """Pairs (a < b) of the distinct ``fingerprint`` values given that differ in at most 4 bits.

    All of them: as many as the square of a dense family. Groups need fewer links, see ``near_roots``.
    """
    keyed = _keys_of(prints)
    left = keyed.withColumnRenamed("fingerprint", "a")
    right = keyed.withColumnRenamed("fingerprint", "b")
    pairs = left.join(_shuffled(right), "key").filter("a < b")
    first = _first_kind("a", "b") == F.shiftright("key", KEY_BITS)
    return pairs.filter(_close("a", "b") & first).select("a", "b").distinct()


def _stars(rows: DataFrame) -> DataFrame:
    """A link (a, b) of each fingerprint of a key to one of two among them that is within 4 bits, if any: the least and
    the greatest in an order that differs from key to key."""
    mask = F.xxhash64("key")
    ordered = F.col("fingerprint").bitwiseXOR(mask)
    ends = rows.groupBy("key").agg(F.min(ordered).alias("low"), F.max(ordered).alias("high")).filter("low < high")
    ends = ends.select("key", *(F.col(end).bitwiseXOR(mask).alias(end) for end in ("low", "high")))
    both = rows.select("key", F.col("fingerprint").alias("a")).join(_shuffled(ends), "key")
    link = F.when((F.col("a") != F.col("low")) & _close("a", "low"), F.col("low"))
    link = link.when((F.col("a") != F.col("high")) & _close("a", "high"), F.col("high"))
    return both.select("a", link.alias("b")).filter("b IS NOT NULL")


def _grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with ``group`` led on to its root in ``groups`` (node, root)."""
    found = rows.join(groups.withColumnRenamed("node", "group"), "group", "left")
    return found.withColumn("group", F.coalesce("root", "group")).drop("root")


def near_roots(prints: DataFrame) -> DataFrame:
    """fingerprint, root: each of the distinct ``fingerprint`` values given, with the smallest that links of at most 4
    bits reach from it.

    Not by all pairs of a bucket, which in a dense family are its square:

    1. Fingerprints that share two of four quarters are linked to two among them, by six keys each. That joins most of a
       dense family.
    2. Buckets of the Golay keys that hold one group alone say nothing new. In the others, members are linked to two of
       them again.
    3. What is left are links between members of different groups. Of two such members one at least is outside the
       bucket's largest group, so only those outside are compared with the rest of the bucket.
    """
    prints = prints.select("fingerprint")
    quarters = [F.col("fingerprint").bitwiseAND(F.lit(_signed(0xFFFF << at))) for at in range(0, 64, 16)]
    shared = [F.xxhash64(F.lit(n), x, y) for n, (x, y) in enumerate(combinations(quarters, 2))]
    groups = stored(connected(_stars(prints.select("fingerprint", F.explode(F.array(*shared)).alias("key")))))
    rooted = stored(_grouped(prints.withColumn("group", F.col("fingerprint")), groups))

    keyed = _keys_of(rooted)
    of_group = _keys_of(rooted, "group")
    several = of_group.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high")
    members = stored(keyed.join(_shuffled(several.select("key")), "key"))
    groups = stored(connected(_between(_stars(members), rooted)))
    rooted = stored(_grouped(rooted, groups))

    members = stored(members.join(_shuffled(rooted), "fingerprint"))
    sizes = members.groupBy("key", "group").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("size", "group"))["group"].alias("largest"))
    outer = sizes.join(_shuffled(largest), "key").filter("group != largest").select("key", "group")
    outside = stored(members.join(_shuffled(outer), ["key", "group"]))
    outside = outside.select("key", F.col("fingerprint").alias("a"), F.col("group").alias("group_a"))
    others = members.select("key", F.col("fingerprint").alias("b"), F.col("group").alias("group_b"))
    links = outside.join(_shuffled(others), "key").filter((F.col("group_a") != F.col("group_b")) & _close("a", "b"))
    groups = stored(connected(links.select(F.col("group_a").alias("a"), F.col("group_b").alias("b"))))
    return _grouped(rooted, groups).select("fingerprint", F.col("group").alias("root"))


def _between(links: DataFrame, rooted: DataFrame) -> DataFrame:
    """Links (a, b) of fingerprints as links between their groups, by ``rooted`` (fingerprint, group)."""
    for end in ("a", "b"):
        group = rooted.select(F.col("fingerprint").alias(end), "group")
        links = links.join(_shuffled(group), end).drop(end).withColumnRenamed("group", f"group_{end}")
    return links.select(F.col("group_a").alias("a"), F.col("group_b").alias("b")).filter("a != b")


def connected(links: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for all nodes of ``links`` (a, b).

    Alternating stars: each node is linked to the smallest in its neighbourhood, first its larger neighbours, then its
    smaller ones, until only stars are left; so many rounds as the logarithm of the size. Smallest neighbours are
    formed before the shuffle, and rows go back to them by a join that Spark can split at a hot node.
    """
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a > b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a > b")
        links = stored(small.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct())


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS
) -> DataFrame:
    """Each document with its group of near duplicates: doc_id, fingerprint (hex), component_id.

    Equal fingerprints are one class from the start, so copies never meet in a bucket; only classes are joined.
    NULL and empty texts have fingerprint zero. NULL ids have a group like others, but are never its smallest id; a
    group of NULL ids alone has component NULL. Repeated rows come out as often as they come in. An empty table gives
    no rows.
    """
    prints = stored(fingerprints(texts(docs, id_col, text_col), width))
    classes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest")))
    rooted = classes.join(_shuffled(stored(near_roots(classes))), "fingerprint")
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    groups = rooted.join(_shuffled(smallest), "root").select("fingerprint", "component_id")
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return prints.join(_shuffled(groups), "fingerprint").select("doc_id", hexed, "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group stays, that of the smallest id, with all its columns; of NULL ids alone, all stay."""
    groups = simhash_groups(docs, id_col, text_col)
    (kept_id,) = fresh(docs, "kept_id")
    keep = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(kept_id))
    return docs.join(keep, named(id_col).eqNullSafe(F.col(kept_id)), "left_semi")
