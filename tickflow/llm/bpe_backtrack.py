"""Byte-level BPE without merging: longest token matches, checked pair by pair, with backtracking."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import texts

#: How the vocabulary's texts are split before encoding, and the same for texts up to U+017F, written
#: with explicit classes for the faster of the two libraries.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
BLANKS = "\t-\r \x85\xa0"
LATIN_PATTERN = (
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{BLANKS}{LETTERS}{NUMBERS}]+"
    f"|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)
BEYOND_LATIN = re.compile("[^\x00-ſ]")
#: Encoded pieces a Python worker remembers before it starts anew.
REMEMBERED = 400_000


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others
    follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class Backtracking:
    """Encoder and decoder of one vocabulary file.

    Ids rise with the rank of the merge that forms a token. Two tokens may stand side by side if no merge across their
    border comes before the merges that finish them; a sequence of such tokens is what merging would give, and the one
    found by taking the longest match first and going back where it fits nothing is unique. Positions that lead
    nowhere are marked, so that each is visited once per token that ends there.
    """

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as opened:
            content = json.load(opened)
        bytes_of = byte_characters()
        ids = {tuple(map(bytes_of.get, token)): number for token, number in content["model"]["vocab"].items()}
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        tokens = [b""] * size
        for token, number in ids.items():
            tokens[number] = bytes(token)
        number_of = {token: number for number, token in enumerate(tokens) if token}
        for token, number in self.special.items():
            tokens[number] = token.encode()
        self.lengths = list(map(len, tokens))
        # The offset table: all tokens in one block, and where each begins.
        self.block = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array(self.lengths)
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))

        self.parts, self.merged = {}, {}
        for pair in content["model"]["merges"]:
            left, right = (bytes(map(bytes_of.get, half)) for half in (pair.split(" ") if isinstance(pair, str) else pair))
            number = number_of[left + right]
            self.parts.setdefault(number, (number_of[left], number_of[right]))
            self.merged.setdefault((number_of[left], number_of[right]), number)

        self.matches = ahocorasick.Automaton()
        for token, number in number_of.items():
            self.matches.add_word(token.decode("latin-1"), number)
        self.matches.make_automaton()
        self.shorter = [-1] * size
        for token, number in number_of.items():
            for end in range(len(token) - 1, 0, -1):
                if (prefix := number_of.get(token[:end])) is not None:
                    self.shorter[number] = prefix
                    break

        self.split = regex.compile(PATTERN).findall
        self.split_latin = re.compile(LATIN_PATTERN).findall
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}

    def _edge(self, token: int, side: int) -> Iterator[tuple[int, int]]:
        """The tokens that in turn stand at the right (1) or left (0) edge while ``token`` is formed, each with the merge
        that ends it."""
        until = 1 << 40
        yield token, until
        while (parts := self.parts.get(token)) is not None:
            until, token = token, parts[side]
            yield token, until

    def fits(self, left: int, right: int) -> bool:
        """Whether merging leaves these two tokens side by side."""
        found = self.compatible.get((left, right))
        if found is None:
            # Of equal merges the one further left comes first.
            found = not any(
                (across := self.merged.get((a, b))) is not None and across < a_ends and across <= b_ends
                for a, a_ends in self._edge(left, 1)
                for b, b_ends in self._edge(right, 0)
            )
            if len(self.compatible) > 4 * REMEMBERED:
                self.compatible.clear()
            self.compatible[left, right] = found
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        longest = [-1] * len(piece)
        for end, token in self.matches.iter(piece.decode("latin-1")):
            longest[end - self.lengths[token] + 1] = token  # ends rise, so the last one is the longest
        open_at = [True] * (len(piece) + 1)
        found: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + self.lengths[token]
            if open_at[end] and (not found or self.fits(found[-1], token)):
                found.append(token)
                if end == len(piece):
                    return found
                at, token = end, longest[end]
                continue
            token = self.shorter[token]
            while token < 0:  # nothing fits here: go back and shorten the token before
                open_at[at] = False
                token = found.pop()
                at -= self.lengths[token]
                token = self.shorter[token]

    def _new(self, piece: str) -> bytes:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = self.known[piece] = np.array(self.encode_piece(piece.encode()), "<u4").tobytes()
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, new = self.known.get, self._new
        out = []
        for part in self.split_special(text) if self.split_special else [text]:
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            pieces = self.split(part) if BEYOND_LATIN.search(part) else self.split_latin(part)
            out += [known(piece) or new(piece) for piece in pieces]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4")
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.offsets[numbers] - ends + sizes, sizes)
        return self.block[at].tobytes().decode("utf-8", "replace")


@cache
def coder(file: str) -> Backtracking:
    """One per Python worker and file."""
    return Backtracking(file)


def encoded(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = 4 << 20) -> DataFrame:
    """Each document as doc_id, ids (little-endian unsigned 32-bit), n_tokens and decoded, the text decoded again.

    The file lies where all executors can read it, as an installed package does. NULL texts count as empty and have no
    ids; bytes that are not UTF-8 count as U+FFFD. Repeated rows and NULL ids come out as they come in; an empty table
    gives no rows. Batches are handed on in parts of about ``part_bytes``, whole documents each.
    """
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    schema = pa.schema([("ids", pa.binary()), ("n_tokens", pa.int64()), ("decoded", pa.string())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(file)
        for batch in batches:
            rows, first, size = [], 0, 0
            for at, text in enumerate(batch.column("text"), 1):
                ids = bpe.encode((text.as_py() or b"").decode("utf-8", "replace"))
                rows.append((ids, len(ids) // 4, bpe.decode(ids)))
                size += 2 * len(ids)
                if size > part_bytes or at == len(batch):
                    columns = [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)]
                    keys = batch.column("doc_id").slice(first, at - first)
                    yield pa.RecordBatch.from_arrays([keys, *columns], ["doc_id", *schema.names])
                    rows, first, size = [], at, 0

    rows = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(each, f"doc_id {kind}, ids binary, n_tokens long, decoded string")
