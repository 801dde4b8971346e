import hashlib
import random
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickflow.llm import suffix_dedup
from tickflow.llm.common import stored
from tickflow.llm.suffix_dedup import LENGTH, drop_repeated_passages, repeated_spans


def brute_force(rows, length=LENGTH):
    first = defaultdict(list)
    raw = [(i, (t or "").encode()) for i, t in rows]
    lowest = {}
    for i, b in raw:
        for s in range(len(b) - length + 1) if i is not None else ():
            w = b[s : s + length]
            lowest[w] = min(i, lowest.get(w, i))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1) if i is not None else ():
            if lowest[b[s : s + length]] < i:
                gone[s : s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    del first
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.drop("spans").collect()), key=repr)


def corpus():
    dice = random.Random(8)
    word = lambda: "".join(dice.choice("abcdeé") for _ in range(dice.randrange(1, 8)))
    passages = [" ".join(word() for _ in range(dice.randrange(8, 60))) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [" ".join(word() for _ in range(dice.randrange(0, 40)))]
        for _ in range(dice.randrange(0, 3)):
            p = dice.choice(passages)
            a = dice.randrange(0, len(p) // 2)
            parts += [p[a : dice.randrange(a, len(p))], " ".join(word() for _ in range(dice.randrange(0, 9)))]
        rows.append((dice.randrange(0, 10_000), "".join(parts)))
    rows += [(20_000 + k, rows[5][1]) for k in range(5)] + [rows[7], rows[7]]  # copies; repeated rows
    rows += [(None, passages[0]), (3, None), (4, ""), (5, "a" * 300), (6, "a" * 49), (7, "a" * 50), (8, "ab" * 5_000)]
    rows += [(rows[9][0], "another text of the same id " + passages[1])]
    return rows


LIMITS = [(200_000, 10_000), (0, 10_000), (200_000, 0), (0, 3)]


@pytest.mark.parametrize("limits", LIMITS)
def test_equals_brute_force(docs_of, limits):
    rows = corpus()
    found = repeated_spans(docs_of(rows), rows_sent=limits[0], together=limits[1])
    assert rows_of(found) == brute_force(rows)


@pytest.mark.parametrize("limits", LIMITS[1:3])
def test_a_passage_in_many_surroundings(docs_of, limits):
    """Half of the documents share a passage between texts of their own, periodic texts meet at all offsets."""
    dice = random.Random(2)
    own = lambda n: "".join(dice.choice("abcdefgh ") for _ in range(n))
    passage = own(70)
    rows = [(i, own(dice.randrange(30, 90)) + passage * (i % 2) + own(60)) for i in range(300, 0, -1)]
    rows += [(1_000 + i, "abcab" * dice.randrange(8, 30)) for i in range(30)] + [(2_000, "x" + passage[5:65] + "y")]
    found = repeated_spans(docs_of(rows, 9), rows_sent=limits[0], together=limits[1])
    assert rows_of(found) == brute_force(rows)


def test_documents_equal_brute_force(docs_of):
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    rows = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
    assert rows_of(repeated_spans(docs_of(rows))) == brute_force(rows)


def test_texts_stay_valid_and_columns_stay(docs_of):
    passage = "é" * 40
    docs = docs_of([(1, passage + " one"), (2, "x" + passage), (3, None), (4, "y" + passage[:30] + "z")])
    left = drop_repeated_passages(docs)
    assert left.columns == docs.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: passage + " one", 2: "x", 3: None, 4: "yz"}
    assert repeated_spans(docs_of([])).count() == 0 and drop_repeated_passages(docs_of([])).count() == 0


def test_rows_of_one_id_lose_their_own_passages_and_names_may_clash(docs_of):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(1, passage), (5, "zz " + passage + " end"), (5, "zz yy xx w " * 20), (5, "zz yy xx w " * 20), (None, passage)]
    docs = docs_of(rows).withColumns({"spans": F.lit(1), "spans_id": F.lit(2), "Spans_Text": F.lit(3), "text_id": F.lit(4)})
    left = drop_repeated_passages(docs)
    assert left.columns == docs.columns
    expected = [(1, passage), (5, "zz  end"), (5, "zz yy xx w " * 20), (5, "zz yy xx w " * 20), (None, passage)]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(expected, key=repr)


def test_one_very_long_text(docs_of):
    dice = random.Random(9)
    long = "".join(dice.choice("abcdefghij ") for _ in range(1_000_000))
    rows = [(1, long[5_000:6_000]), (2, long), (3, "a" * 400_000), (4, "b" + "a" * 1_000)]
    found = {r.doc_id: (r.n_removed, r.n_spans) for r in repeated_spans(docs_of(rows)).collect()}
    assert found == {1: (0, 0), 2: (1_000, 1), 3: (0, 0), 4: (1_000, 1)}


def test_a_full_filter_changes_nothing(docs_of):
    """Sixteen bits let nearly every key through."""
    rows = corpus()
    assert rows_of(repeated_spans(docs_of(rows), filter_bits=16)) == brute_force(rows)


@pytest.mark.parametrize("together", [10_000, 3])
def test_a_context_is_stored_once_not_for_each_document(docs_of, monkeypatch, together):
    dice = random.Random(4)
    own = lambda n: "".join(dice.choice("abcdefgh ") for _ in range(n))
    shared = own(3_000)
    rows = [(i, own(60) + shared + own(60)) for i in range(120)]
    kept = []

    def counted(frame, folder=None):
        kept.append(stored(frame, folder))
        return kept[-1]

    monkeypatch.setattr(suffix_dedup, "stored", counted)
    found = repeated_spans(docs_of(rows), together=together)
    assert rows_of(found) == brute_force(rows)
    contexts = len(rows) * len(suffix_dedup.samples(shared.encode())[0])
    assert sum(frame.count() for frame in kept) < contexts / 2
