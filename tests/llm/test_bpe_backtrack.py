import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickflow.llm.bpe_backtrack import coder, encoded

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)


def ids(text):
    return np.frombuffer(coder(FILE).encode(text), "<u4").tolist()


def check(text):
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids(text) == expected, text
    assert coder(FILE).decode(coder(FILE).encode(text)) == LIBRARY.decode(expected, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check(text)


@settings(max_examples=400, deadline=None)
@given(st.text("aabcehnort' .0\n<|>", max_size=80))
def test_repetitive_text(text):
    check(text)


def test_whole_documents_and_specials():
    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()[:150]:
        check(text)
    for text in ["", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "a" * 3_000, " " * 500 + "x", "xx" * 501 + "é" * 99]:
        check(text)


def test_every_character_and_random_letters():
    step = 61
    for low in range(0, 0x110000, step):
        chars = [chr(c) for c in range(low, min(low + step, 0x110000)) if not 0xD800 <= c < 0xE000]
        if low < 0x3400 or low % (61 * 40) == 0:
            check(" a".join(chars))
    dice = random.Random(4)
    for _ in range(3_000):
        check("".join(dice.choice("etaoinshrdlu") for _ in range(dice.randrange(1, 30))))


def test_tables(docs_of):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, "word " * 40_000)]
    found = sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in encoded(docs_of(rows), FILE, part_bytes=100).collect())
    expected = sorted((i or 0, len(LIBRARY.encode(t or "").ids), t or "") for i, t in rows)
    assert found == expected
    assert encoded(docs_of([]), FILE).count() == 0
