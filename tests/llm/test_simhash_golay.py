import random

import numpy as np
import xxhash

from tickflow.llm import simhash_golay
from tickflow.llm.common import stored
from tickflow.llm.simhash_golay import codewords, drop_near_copies, fingerprint, near_pairs, near_roots, simhash_groups


def brute_print(text):
    words = [bytes(w) for w in bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, f"{prints[i]:016x}", min(ids, default=None)))
    return out


def by_row(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_words_within_two_bits_share_a_codeword():
    dice = np.random.default_rng(3)
    words = dice.integers(0, 1 << 23, 20_000)
    other = words ^ (1 << dice.integers(0, 23, 20_000)) ^ (1 << dice.integers(0, 23, 20_000))
    one, two = codewords(words), codewords(other)
    assert ((one[:, :, None] == two[:, None, :]) & (one >= 0)[:, :, None]).any(axis=(1, 2)).all()
    assert set((one >= 0).sum(axis=1).tolist()) == {1, 6}


def test_pairs_equal_brute_force(spark):
    dice = random.Random(5)
    prints = {dice.getrandbits(64) for _ in range(150)}
    for p in list(prints):
        for errors in range(1, 7):
            x = p
            for bit in dice.sample(range(64), errors):
                x ^= 1 << bit
            prints.add(x)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    found = near_pairs(spark.createDataFrame([(p,) for p in signed], "fingerprint long")).collect()
    close = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == close and len(close) > 600


def test_roots_equal_brute_force(spark):
    """Sparse and dense families, chains, and strays within 4 bits of the edge of a family alone."""
    dice = random.Random(8)

    def changed(value, errors):
        for bit in dice.sample(range(64), errors):
            value ^= 1 << bit
        return value

    prints = {dice.getrandbits(64) for _ in range(100)}
    for centre in [dice.getrandbits(64) for _ in range(3)]:
        family = [changed(centre, dice.randrange(1, 4)) for _ in range(250)]
        prints |= {centre, *family, *(changed(p, 4) for p in family[:40])}
    for _ in range(20):
        link = dice.getrandbits(64)
        for _ in range(8):
            link = changed(link, dice.randrange(3, 6))
            prints.add(link)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    values, root = np.array(signed, np.int64), np.arange(len(signed))
    near = np.bitwise_count((values[:, None] ^ values[None, :]).view(np.uint64)) <= 4
    while True:
        least = np.where(near, root[None, :], len(signed)).min(axis=1)
        if (least == root).all():
            break
        root = least
    found = near_roots(spark.createDataFrame([(p,) for p in signed], "fingerprint long")).collect()
    assert sorted(tuple(r) for r in found) == [(p, signed[r]) for p, r in zip(signed, root.tolist())]
    assert 100 < len(set(root.tolist())) < len(signed) - 700


def test_groups_equal_brute_force(docs_of):
    dice = random.Random(2)
    words = [f"W{i}é" for i in range(400)]
    rows = [(None, ""), (5, None), (6, " \n"), (7, "a"), (8, "A"), (9, "b"), (None, "only null"), (8, "A")]
    for i in range(12):
        base = [dice.choice(words) for _ in range(300)]
        for k in range(6):
            changed = list(base)
            for _ in range(k):
                changed[dice.randrange(300)] = dice.choice(words)
            rows.append((1_000 - 7 * len(rows), "\t".join(changed)))
    rows.append((2_000, "x y " * 50_000))
    found = by_row(tuple(r) for r in simhash_groups(docs_of(rows)).collect())
    expected = by_row(brute_groups(rows))
    assert found == expected and len({r[2] for r in expected}) < len(rows) - 15
    kept = drop_near_copies(docs_of(rows)).select("doc_id").collect()
    assert {r.doc_id for r in kept} == {r[2] for r in expected}
    assert all(fingerprint((t or "").encode()) == brute_print(t) for _, t in rows[:20])


def sent_tables(rows):
    """The parts of the plan below each exchange that sends a table to all tasks."""
    lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for n, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = next((m for m in range(n + 1, len(lines)) if depth[m] <= depth[n]), len(lines))
            yield "\n".join(lines[n:below])


def test_tables_of_keys_are_not_sent_to_all_tasks(spark, monkeypatch):
    """A fingerprint has over a hundred keys, which Spark's estimate leaves out."""
    sent, of_keys = [], []

    def watched(rows):
        sent.extend(sent_tables(rows))
        of_keys.append("key" in rows.columns)
        return stored(rows)

    monkeypatch.setattr(simhash_golay, "stored", watched)
    prints = spark.createDataFrame([(p,) for p in [*range(40), *range(0xFFFF << 40, (0xFFFF << 40) + 40)]], "fingerprint long")
    links = near_pairs(prints)
    assert near_roots(stored(prints)).select("root").distinct().count() == 2
    sent.extend(sent_tables(links))
    assert any(of_keys) and sent and not [table for table in sent if "key#" in table]


def test_empty_table(docs_of):
    assert simhash_groups(docs_of([])).count() == 0
