"""SentencePiece's merge-type encoding without merging: longest matches, checked pair by pair, with backtracking.

A model of this type starts from single characters and merges, again and again, the neighbours whose concatenation is
the piece of the best score, the leftmost of equal ones. What merging does inside two neighbouring pieces does not
depend on what lies around them until a merge crosses their borders. So a sequence of pieces is the result of merging
exactly if that is true of each pair of neighbours alone, and :meth:`Pieces.fits` tells it by merging the pair's text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import texts

#: Fixed value: the character that stands for a space in pieces.
SPACE = "▁"
#: Encoded parts of texts, and checked pairs, that a Python worker remembers before it starts anew, and the longest such
#: part in characters. They bound memory only.
REMEMBERED = 400_000
REMEMBERED_CHARACTERS = 64


class Pieces:
    """Encoder and decoder of one model file: merge type, no normalisation but for spaces, unknown characters as bytes."""

    def __init__(self, file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        size = model.vocab_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        bytes_of = {int(model.id_to_piece(n)[1:-1], 16): n for n in range(size) if model.is_byte(n)}
        if len(bytes_of) < 256 or self.begin < 0 or self.end < 0:
            raise ValueError("the model needs pieces for all bytes, and begin and end ids")
        plain = [n for n in range(size) if not (model.is_byte(n) or model.is_control(n) or model.is_unknown(n))]
        self.pieces = {model.id_to_piece(n): n for n in plain}
        self.score = {piece: model.get_score(n) for piece, n in self.pieces.items()}
        self.byte_ids = [bytes_of[b] for b in range(256)]

        # Characters that only occur inside pieces can't be told from others until merged: they stand for themselves.
        self.lengths = {piece: len(piece) for piece in self.pieces}
        for character in {c for piece in self.pieces for c in piece} - self.pieces.keys():
            self.lengths[character] = 1
        self.matches = ahocorasick.Automaton()
        for piece in self.lengths:
            self.matches.add_word(piece, piece)
        self.matches.make_automaton()
        self.shorter = {
            piece: next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.lengths), None)
            for piece in self.lengths
        }

        # Between two characters that no piece holds side by side nothing is ever merged. If that is so for a space
        # after any other character, texts fall into words there.
        after_letter = any(a != SPACE and b == SPACE for piece in self.pieces for a, b in zip(piece, piece[1:]))
        self.split = (lambda text: [text]) if after_letter else re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall

        # The offset table: what each id decodes to, in one block, and where it begins.
        blocks = [b""] * size
        for piece, n in self.pieces.items():
            blocks[n] = piece.replace(SPACE, " ").encode()
        for value, n in bytes_of.items():
            blocks[n] = bytes([value])
        self.block = np.frombuffer(b"".join(blocks), np.uint8)
        self.sizes = np.array(list(map(len, blocks)))
        self.offsets = np.cumsum(self.sizes) - self.sizes

        self.compatible: dict[tuple[str | None, str], bool] = {}
        self.known: dict[str, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """What merging makes of a short text, step by step."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: str | None, right: str) -> bool:
        """Whether merging leaves these two pieces side by side (without a left one: whether it ever forms the right)."""
        found = self.compatible.get((left, right))
        if found is None:
            if len(self.compatible) >= 4 * REMEMBERED:
                self.compatible.clear()
            found = self.merge((left or "") + right) == ([right] if left is None else [left, right])
            self.compatible[left, right] = found
        return found

    def _stretch(self, longest: list[str | None], first: int, stop: int) -> list[str]:
        """The pieces of the known characters from ``first`` up to ``stop``."""
        size = stop - first
        failed = bytearray(size // 8 + 1)  # a bit for each position that leads nowhere
        found: list[str] = []
        at, piece = 0, longest[first]
        while True:
            end = at + self.lengths[piece]
            if not failed[end >> 3] >> (end & 7) & 1 and self.fits(found[-1] if found else None, piece):
                found.append(piece)
                if end == size:
                    return found
                at, piece = end, longest[first + end]
                continue
            piece = self.shorter[piece]
            while piece is None:  # nothing fits here: go back and shorten the piece before
                failed[at >> 3] |= 1 << (at & 7)
                piece = found.pop()
                at -= self.lengths[piece]
                piece = self.shorter[piece]

    def encode_part(self, text: str) -> list[int]:
        """Ids of a text without its begin and end; spaces are already replaced."""
        longest: list[str | None] = [None] * len(text)
        for end, piece in self.matches.iter(text):
            longest[end - self.lengths[piece] + 1] = piece  # ends rise, so the last one is the longest
        ids: list[int] = []
        at, size = 0, len(text)
        while at < size:
            stop = at
            while stop < size and longest[stop] is not None:
                stop += 1
            if stop > at:
                for piece in self._stretch(longest, at, stop):
                    number = self.pieces.get(piece)
                    ids += [number] if number is not None else [self.byte_ids[b] for b in piece.encode()]
            if stop < size:
                ids += [self.byte_ids[b] for b in text[stop].encode()]
            at = stop + 1
        return ids

    def _new(self, part: str) -> bytes:
        found = np.array(self.encode_part(part), "<u4").tobytes()
        if len(part) <= REMEMBERED_CHARACTERS:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[part] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids, with those of begin and end, as little-endian unsigned 32-bit integers."""
        known, new = self.known.get, self._new
        parts = self.split(SPACE + text.replace(" ", SPACE)) if text else []
        inner = b"".join([known(part) or new(part) for part in parts])
        return self.begin.to_bytes(4, "little") + inner + self.end.to_bytes(4, "little")

    def decode(self, ids: bytes) -> str:
        """The text of the ids, without the space put before it."""
        numbers = np.frombuffer(ids, "<u4")
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.offsets[numbers] - ends + sizes, sizes)
        return self.block[at].tobytes().decode("utf-8", "replace").removeprefix(" ")


@cache
def pieces_of(file: str) -> Pieces:
    """One per Python worker and file."""
    return Pieces(file)


def piece_ids(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = 4 << 20) -> DataFrame:
    """Each document as doc_id, ids (little-endian unsigned 32-bit, begin and end included), n_tokens and decoded.

    The file lies where all executors can read it, as an installed package does. NULL texts count as empty: the begin
    and the end id alone. Bytes that are not UTF-8 count as U+FFFD; the space character of pieces decodes to a space, as
    in the library. Repeated rows and NULL ids come out as they come in; an empty table gives no rows. Batches are
    handed on in parts of about ``part_bytes``, whole documents each.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    types = [pa.binary(), pa.int64(), pa.string()]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces_of(file)
        for batch in batches:
            out, first, size = [], 0, 0
            for at, text in enumerate(batch.column("text"), 1):
                ids = coder.encode(text.as_py().decode("utf-8", "replace"))
                out.append((ids, len(ids) // 4, coder.decode(ids)))
                size += 2 * len(ids)
                if size > part_bytes or at == len(batch):
                    columns = [pa.array(column, of) for column, of in zip(zip(*out), types)]
                    keys = batch.column("doc_id").slice(first, at - first)
                    yield pa.RecordBatch.from_arrays([keys, *columns], ["doc_id", "ids", "n_tokens", "decoded"])
                    out, first, size = [], at, 0

    return rows.mapInArrow(each, f"doc_id {kind}, ids binary, n_tokens long, decoded string")
