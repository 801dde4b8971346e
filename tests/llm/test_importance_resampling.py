import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickflow.llm.importance_resampling import Checksums, ranked, resampled, splitters, words_of

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    words = WORD.findall((text or "").encode().lower())
    return len(words), [b" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute_force(rows, target, percent=5):
    bucket = lambda g: zlib.crc32(g) % 10_000
    found = [(i, *grams(t)) for i, t in rows]
    s = Counter(bucket(g) for _, _, gs in found for g in gs)
    t = Counter(bucket(g) for text in target for g in grams(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    scored = []
    for i, n, gs in found:
        weight = sum(gain(bucket(g)) for g in gs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in scored if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = able[: percent * len(able) // 100]
    ranks = [(*r, k) for k, r in enumerate(drawn, 1)]
    rest = Counter(scored) - Counter(drawn)
    return sorted(ranks + [(*r, None) for r in rest.elements()], key=repr)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_checksums_of_any_words():
    dice = random.Random(1)
    table = Checksums()
    for _ in range(300):
        words = [bytes(dice.choice(b"abz09\xc3\xa9") for _ in range(dice.choice((1, 2, 5, 63, 64, 65, 200)))) for _ in range(dice.randrange(12))]
        for width in (1, 2, 3, 5):
            expected = [zlib.crc32(b" ".join(words[i : i + k])) for k in range(1, width + 1) for i in range(len(words) - k + 1)]
            assert (table.features(words, width).tolist() if words else []) == expected
    assert words_of("Ab-c9\x00ÉÄ\x7fx_y\u0085".encode()) == WORD.findall("Ab-c9\x00ÉÄ\x7fx_y\u0085".encode().lower())


def test_documents_equal_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{folder}/documents.parquet")
    target = pq.read_table(f"{folder}/benchmark.parquet")["text"].to_pylist()
    found = resampled(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert rows_of(found) == brute_force(list(zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist())), target)


@pytest.mark.parametrize("segments", [1, 3, 40])
def test_hard_rows(docs_of, segments):
    dice = random.Random(6)
    words = ["ab", "cd", "É", "x" * 90, "the", "0"]
    rows = [(i, " ".join(dice.choice(words) for _ in range(dice.randrange(10, 60)))) for i in range(200)]
    rows += [rows[3]] * 40 + [(None, rows[4][1]), (300, None), (301, ""), (302, " .,"), (303, "word " * 30_000)]
    docs = docs_of(rows, 7).withColumns({"row": F.lit(1), "rank": F.lit(2), "segment": F.lit("s")})
    target = docs_of([(1, "the É the"), (2, None)])
    found = resampled(docs, target, percent=30, segments=segments)
    assert rows_of(found) == brute_force(rows, ["the É the", None], 30)


def test_empty_tables(docs_of):
    assert resampled(docs_of([]), docs_of([])).count() == 0
    rows = [(i, f"a b c {i} " * 9) for i in range(40)]
    assert rows_of(resampled(docs_of(rows), docs_of([]))) == brute_force(rows, [])


def test_segments_are_even_and_ranks_exact(spark):
    rows = spark.range(0, 60_000, 1, 16).select(
        F.col("id").alias("doc_id"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("score"), F.col("id").alias("row")
    )
    rows = rows.withColumn("score", F.when(F.col("doc_id") < 20_000, 7).otherwise(F.col("score")))
    parting = splitters(rows, 12, 60_000)
    keys = sorted((-r.score, False, r.doc_id, r.row) for r in rows.collect())
    places = [0, *[keys.index(p) for p in parting], len(keys)]
    assert len(parting) == 11 and max(b - a for a, b in zip(places, places[1:])) <= 2 * 60_000 // 12
    found = {r.doc_id: r.rank for r in ranked(rows, 25_000, 60_000, 12).collect()}
    expected = {key[2]: k for k, key in enumerate(keys, 1)}
    assert all(found[i] == (k if k <= 25_000 else None) for i, k in expected.items())
