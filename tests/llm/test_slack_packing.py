import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickflow.llm.slack_packing import fullest, ids_of, packed, patterns

FILE = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("aAéÉ'sSz09 \n<|>İßſ", max_size=80))
def test_ids_are_the_librarys(text):
    assert np.frombuffer(ids_of(FILE).encode(text), "<u4").tolist() == library(text)


def test_ids_of_documents():
    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()[:100]:
        assert np.frombuffer(ids_of(FILE).encode(text), "<u4").tolist() == library(text)
    for low in range(1, 0x180):
        text = f"{chr(low)}a{chr(low)}{chr(low)} 1{chr(low)}'s"
        assert np.frombuffer(ids_of(FILE).encode(text), "<u4").tolist() == library(text), low
    assert ids_of(FILE).encode("a<|endoftext|>b") == np.array(library("a<|endoftext|>b"), "<u4").tobytes()


def test_fullest_equals_brute_force():
    dice = random.Random(3)
    for _ in range(200):
        counts = {dice.randrange(1, 30): dice.randrange(1, 4) for _ in range(dice.randrange(1, 6))}
        room = dice.randrange(0, 60)
        chosen = fullest(counts, room)
        sums = [sum(n * k for n, k in zip(ns, counts)) for ns in product(*(range(c + 1) for c in counts.values()))]
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)
        assert all(0 < n <= counts[k] for k, n in chosen.items())


def test_patterns_use_every_length_once_and_stay_few():
    dice = random.Random(1)
    counts = Counter(min(4096, 1 + int(dice.expovariate(1 / 900))) for _ in range(200_000))
    used, plan = Counter(), patterns(dict(counts))
    for repeats, chosen in plan:
        assert sum(k * n for k, n in chosen.items()) <= 4096
        for k, n in chosen.items():
            used[k] += repeats * n
    assert used == counts and len(plan) < 8_192
    sequences, tokens = sum(r for r, _ in plan), sum(k * n for k, n in counts.items())
    assert tokens / (4096 * sequences) > 0.99


def check(rows, found, capacity):
    pieces, places = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id, r.row_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for taken in places.values():
        at = 0
        for offset, length in sorted(taken):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(places) == list(range(len(places)))
    expected = Counter()
    for i, t in rows:
        ids = library(t) + [2]
        for s in range(0, len(ids), capacity):
            part = np.array(ids[s : s + capacity], "<u4").tobytes()
            expected[(i, s, len(part) // 4, part, zlib.crc32(part), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, bytes(r.ids), r.ids_crc32, r.doc_tokens) for r in found) == expected


def test_pieces_and_places(docs_of):
    dice = random.Random(6)
    rows = [(i, " ".join(dice.choice(["a", "bé", "c1"]) for _ in range(dice.randrange(0, 90)))) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "x y"), (502, "same"), (502, "same"), (503, "long word " * 3_000)]
    rows += [(1_000 + i, "a copy of one") for i in range(60)]
    found = packed(docs_of(rows), FILE, capacity=64, share_documents=50).collect()
    check(rows, found, 64)
    padding = 64 * len({r.sequence_id for r in found}) - sum(r.length for r in found)
    assert padding < 0.02 * 64 * len({r.sequence_id for r in found})
    assert packed(docs_of([]), FILE).count() == 0
