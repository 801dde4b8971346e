import random
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickflow.llm.periodic_runs import collapsed, lag_scan, periodic_runs, runs_of, surviving


def brute_force(words, exponent=4, shortest=6):
    """Every stretch of equal places of every lag, followed word by word; the period is tried from 1 on."""
    found, n = [], len(words)
    for lag in range(1, n // exponent + 1):
        at = 0
        while at < n - lag:
            stop = at
            while stop < n - lag and words[stop] == words[stop + lag]:
                stop += 1
            length = stop + lag - at
            if stop > at and length >= max(shortest, exponent * lag):
                part = words[at : at + length]
                if not any(all(part[i] == part[i + d] for i in range(length - d)) for d in range(1, lag)):
                    found.append((at, length, lag))
            at = stop + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60))
def test_two_words(words):
    assert runs_of(words) == brute_force(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abcd", min_size=1, max_size=7), st.integers(1, 9)), max_size=8), st.integers(3, 6))
def test_repeated_pieces(pieces, exponent):
    words = [c for piece, times in pieces for c in piece * times]
    assert runs_of(words, exponent) == brute_force(words, exponent)


def test_stretches_hold_no_rare_words():
    dice = random.Random(3)
    words = [dice.choice("abcdefghijklmnop") for _ in range(3_000)]
    words[100:300] = list("xyzzy" * 40)
    codes = np.array([ord(w) for w in words])
    found = surviving(codes)
    assert any(a <= 100 and b >= 300 for a, b in found)
    for a, b in found:
        assert b - a >= 6 and min(Counter(words[a:b]).values()) >= 4
    assert runs_of(words) == brute_force(words)


@pytest.mark.parametrize("words", [["a"] * 300_000, ["a", "b"] * 150_000, [str(i % 70_000) for i in range(300_000)]])
def test_long_periodic_texts(words):
    start = time.perf_counter()
    (run,) = runs_of(words)
    assert run == (0, 300_000, len(set(words))) and time.perf_counter() - start < 30
    assert len(collapsed(words, [run])) == len(set(words))


def test_fibonacci_words():
    a, b = ["a"], ["a", "b"]
    while len(b) < 1_500:
        a, b = b, b + a
    tripled = (b[:40] * 5 + b)[:1_500]
    assert runs_of(b, 3) == brute_force(b, 3) and runs_of(tripled, 3) == brute_force(tripled, 3)
    assert lag_scan(np.zeros(5, np.int64)) == []


def test_tables(docs_of):
    run = "x y z " * 5
    long = " ".join(f"w{i % 9_000}" for i in range(60_000))
    rows = [(1, None), (2, " \n"), (None, run), (3, "q " + run + "é\u0085"), (3, "q " + run + "é\u0085"), (4, long), (5, "a a a a a")]
    found = sorted(periodic_runs(docs_of(rows), part_bytes=50).collect(), key=lambda r: (r.doc_id or 0, r.n_words))
    spans = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in found]
    third = (3, 17, [(1, 15, 3)])
    assert spans == [
        (None, 15, [(0, 15, 3)]), (1, 0, []), (2, 0, []), third, third, (4, 60_000, [(0, 60_000, 9_000)]), (5, 5, [])
    ]
    assert [r.collapsed for r in found[:5]] == ["x y z", "", "", "q x y z é\u0085", "q x y z é\u0085"]
    assert found[5].collapsed == " ".join(f"w{i}" for i in range(9_000)) and found[6].collapsed == "a a a a a"
    assert periodic_runs(docs_of([])).count() == 0
