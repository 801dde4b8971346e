"""License scans: winnowed fingerprints of templates in an inverted index, then banded alignment of the candidates."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tickflow.llm.common import texts

GRAM_WORDS = 3
#: Any run of GRAM_WORDS + WINDOW - 1 words in common has a fingerprint in common.
WINDOW = 2
BAND = 8
MIN_COVERAGE = 0.8
TOKEN = re.compile(r"\w+(?:[.+-]+\w+)*")

#: Public notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'
    ),
}


def tokens(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Words in lower case, and where each starts and stops in the text."""
    found = list(TOKEN.finditer(text))
    return [m.group().lower() for m in found], [m.span() for m in found]


def winnowed(words: list[str]) -> list[tuple[int, int]]:
    """(fingerprint, word position): of each window of grams the smallest hash, the rightmost of equal ones."""
    grams = [
        xxhash.xxh64_intdigest(" ".join(words[n : n + GRAM_WORDS])) for n in range(len(words) - GRAM_WORDS + 1)
    ]
    chosen = {}
    for low in range(max(1, len(grams) - WINDOW + 1) if grams else 0):
        window = range(low, min(low + WINDOW, len(grams)))
        at = min(window, key=lambda n: (grams[n], -n))
        chosen[at] = grams[at]
    return [(h, at) for at, h in chosen.items()]


def aligned(template: list[str], words: list[str], start: int, band: int = BAND) -> tuple[int, int, int]:
    """(matched words, first, last) of the best alignment of the template near ``start``, within the band.

    Row by row of the template; each cell holds the most matches, then the beginning nearest to ``start``.
    """
    none = (0, 0, 0, 0)
    before: dict[int, tuple[int, int, int, int]] = {}
    for n, word in enumerate(template):
        low, high = max(0, start + n - band), min(len(words) - 1, start + n + band)
        now, left = {}, none
        for at in range(low, high + 1):
            best = max(left, before.get(at, none))
            if words[at] == word:
                matched, _, _, first = before.get(at - 1, none)
                first = first if matched else at
                best = max(best, (matched + 1, -abs(first - start), -at, first))
            now[at] = left = best
        last = max(now) if now else -1
        # What a row reached stays in reach as the band moves on.
        if now:
            now[last + 1] = now[last]
        before = now or before
    matched, _, last, first = max(before.values(), default=none)
    return matched, first, -last


class Index:
    """Fingerprints of the templates, which the caller gives: as bounded as they are."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: tokens(text)[0] for name, text in templates.items()}
        self.places: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for name, words in self.words.items():
            for fingerprint, at in winnowed(words):
                self.places[fingerprint].append((name, at))

    def scan(self, text: str, min_coverage: float) -> list[tuple[str, int, int, int, float]]:
        """(license, first character, after the last, matched words, coverage); of overlapping matches of one license
        the one with the most words, then the first."""
        words, spans = tokens(text)
        starts = defaultdict(set)
        for fingerprint, at in winnowed(words):
            for name, offset in self.places.get(fingerprint, ()):
                starts[name].add(at - offset)
        found = []
        for name, candidates in starts.items():
            template, hits = self.words[name], []
            for start in sorted(candidates):
                matched, first, last = aligned(template, words, start)
                if matched and matched >= min_coverage * len(template):
                    hits.append((-matched, first, last))
            taken: list[tuple[int, int]] = []
            for matched, first, last in sorted(set(hits)):
                if all(last < a or first > b for a, b in taken):
                    taken.append((first, last))
                    found.append((name, spans[first][0], spans[last][1], -matched, -matched / len(template)))
        return sorted(found, key=lambda f: (f[1], f[0]))


def license_matches(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """A row per match: doc_id, license, start, stop (characters), matched (words), coverage (of the template).

    No shuffle: the index of the templates goes to each task, a text is scanned whole. NULL and empty texts have no
    match; repeated rows and NULL ids come out as often as they come in. Empty tables or templates give no rows.
    """
    given = TEMPLATES if templates is None else templates
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(given)
        for batch in batches:
            at, out = [], []
            for n, text in enumerate(batch.column("text")):
                for match in index.scan(text.as_py(), min_coverage):
                    at.append(n)
                    out.append(match)
            if out:
                columns = [pa.array(column, t) for column, t in zip(zip(*out), types)]
                names = ["doc_id", "license", "start", "stop", "matched", "coverage"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), *columns], names)

    return rows.mapInArrow(each, f"doc_id {kind}, license string, start long, stop long, matched long, coverage double")
