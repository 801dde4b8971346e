import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tickflow.llm.sentencepiece_backtrack import piece_ids, pieces_of

FILE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=FILE)


def library_ids(text):
    return LIBRARY.encode(text, add_bos=True, add_eos=True)


def check(text):
    coder, expected = pieces_of(FILE), library_ids(text)
    ids = coder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == expected, text
    assert coder.decode(ids) == LIBRARY.decode(expected), text


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check(text)


@settings(max_examples=500, deadline=None)
@given(st.text("aabcehnort' .0\n▁<s>", max_size=80))
def test_repetitive_text(text):
    check(text)


def test_whole_documents():
    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()[:150]:
        check(text)


def test_hard_texts():
    for text in ["", " ", "  ", "▁", "▁ x", "<s>", "</s> <unk>", "<0x0A>", "\0", "�", "a" * 5_000, " " * 700 + "x",
                 "xx" * 501 + "é" * 99, "\U0001f600" * 50, "ab\tcd\r\n", "hello  world " * 500, "梦" * 400, "﻿a", "é"]:
        check(text)
    dice = random.Random(4)
    for _ in range(3_000):
        check("".join(dice.choice("etaoinshrdlu") for _ in range(dice.randrange(1, 40))))


def test_every_character():
    step = 61
    for low in range(0, 0x110000, step):
        chars = [chr(c) for c in range(low, min(low + step, 0x110000)) if not 0xD800 <= c < 0xE000]
        if low < 0x3400 or low % (61 * 40) == 0:
            check(" a".join(chars))


def test_tables(docs_of):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, "word " * 40_000)]
    found = sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in piece_ids(docs_of(rows), FILE, part_bytes=100).collect())
    assert found == sorted((i or 0, len(library_ids(t or "")), t or "") for i, t in rows)
    assert piece_ids(docs_of([]), FILE).count() == 0
