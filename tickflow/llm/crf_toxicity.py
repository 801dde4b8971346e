"""Toxicity: a linear-chain conditional random field marks toxic words; its marginals give spans and a document score."""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import named, texts

TOKEN = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 18
#: Bounds of the labelled sample: documents of each label, and characters in a document. Scoring has no such bounds.
SAMPLE_DOCUMENTS = 4_000
SAMPLE_CHARACTERS = 20_000
CONTEXT = 8
ROUNDS = 60
#: Pieces of text whose expectations are worked out at a time.
BLOCK = 4_096
REMEMBERED = 400_000
LIMIT = 30.0
#: An unseen word makes a toxic stretch that goes on through it less likely by at least this much (as a logarithm), and
#: words of a smaller probability than the second number say nothing about their document.
UNSEEN_COST = 2.0
LEAST_PROBABILITY = 0.1


def word_features(word: str) -> list[str]:
    """The word in lower case and its beginnings, each marked by its kind."""
    word = word.lower()
    return ["=" + word] + [f"{n}{word[:n]}" for n in (4, 5, 6) if len(word) >= n]


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


@dataclass
class Field:
    """Weights of word features for the toxic state, transitions (from, to), and the document score's coefficients."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray
    document: tuple[float, float, float] = (0.0, 0.0, -20.0)
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def _new(self, word: str) -> float:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = self.bias + float(self.weights[[bucket(f) for f in word_features(word)]].sum())
        found = self.known[word] = min(LIMIT, max(-LIMIT, found))
        return found

    def evidence(self, words: list[str]) -> np.ndarray:
        known, new = self.known.get, self._new
        return np.array([e if (e := known(w)) is not None else new(w) for w in words], np.float64)

    def marginals(self, evidence: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of the toxic state at each word, by forward-backward over all sequences side by side.

        With two states each message is one ratio, and a step is a fraction of linear terms in it.
        """
        order = sorted(range(len(evidence)), key=lambda n: -len(evidence[n]))
        sizes = np.array([len(evidence[n]) for n in order], np.int64)
        if not len(sizes) or not sizes[0]:
            return [np.zeros(0) for _ in evidence]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        factor = np.exp(np.concatenate([evidence[n] for n in order]))
        forward, backward = np.empty_like(factor), np.empty_like(factor)
        (t00, t01), (t10, t11) = np.exp(self.moves)
        open_at = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # sequences longer than t
        ratio = np.ones(len(sizes))
        for t in range(sizes[0]):
            at = starts[: open_at[t]] + t
            r = ratio[: len(at)]
            ratio = factor[at] * (t01 + r * t11) / (t00 + r * t10) if t else factor[at]
            forward[at] = ratio
        after = np.ones(len(sizes))
        for t in range(sizes[0] - 1, -1, -1):
            at = starts[: open_at[t]] + t
            has_next = open_at[t + 1] if t + 1 < sizes[0] else 0
            s = after[: len(at)]
            if has_next:
                ahead = factor[at[:has_next] + 1] * s[:has_next]
                s[:has_next] = (t10 + t11 * ahead) / (t00 + t01 * ahead)
            backward[at] = s
        odds = forward * backward
        found = odds / (1 + odds)
        result: list[np.ndarray] = [found] * len(evidence)
        for place, n in enumerate(order):
            result[n] = found[starts[place] : starts[place] + sizes[place]]
        return result

    def score(self, marginals: np.ndarray) -> float:
        """Probability that the document is toxic, from the number of toxic words expected and the surest one."""
        expected, surest, base = self.document
        signs = document_signs(marginals)
        x = expected * signs[0] + surest * signs[1] + base
        return float(1 / (1 + np.exp(-np.clip(x, -LIMIT, LIMIT))))


def document_signs(marginals: np.ndarray) -> tuple[float, float]:
    """Logarithm of the number of toxic words expected, and the highest probability of a word. Improbable words count
    nothing, so a text does not become suspicious by its length."""
    told = marginals[marginals >= LEAST_PROBABILITY]
    return float(np.log(told.sum() + 1e-3)), float(told.max()) if len(told) else 0.0


def telling(sample: list[tuple[list[str], int]]) -> set[str]:
    """Features that explain toxic documents and are hardly ever in others: they label the words of toxic documents.

    Each time the feature with the most documents not yet explained is taken. So words that merely come along with
    toxic ones, as in near copies of a document, are not taken for toxic. Features of every twentieth toxic document are
    taken in any case.
    """
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    totals = [0, 0]
    for words, label in sample:
        totals[label] += 1
        counts[label].update({f for word in set(words) for f in word_features(word)})
    clean, toxic = counts
    least = min(8, max(2, totals[1] // 5))
    scale = totals[1] / max(1, totals[0])
    open_: dict[str, set[int]] = {f: set() for f, n in toxic.items() if n >= least and clean[f] * scale <= 0.01 * n}
    for n, (words, label) in enumerate(sample):
        if label:
            for f in {f for word in set(words) for f in word_features(word)}:
                if f in open_:
                    open_[f].add(n)
    chosen = {f for f, docs in open_.items() if len(docs) >= max(least, totals[1] / 20)}
    while open_:
        best = max(open_, key=lambda f: (len(open_[f]), f))
        explained = open_.pop(best)
        chosen.add(best)
        open_ = {f: rest for f, docs in open_.items() if len(rest := docs - explained) >= least}
    return chosen


def fit(sample: list[tuple[str, int]], rounds: int = ROUNDS) -> Field:
    """Fit on (text, label) rows; the same rows in any order give the same field."""
    pool: dict[str, str] = {}  # each distinct word once
    tokens = [
        ([pool.setdefault(word, word) for word in TOKEN.findall(text)], label)
        for text, label in sorted(set(sample), key=lambda row: (row[1], row[0]))
    ]
    seeds = telling(tokens)
    model = Field(np.zeros(BUCKETS), -4.0, np.zeros((2, 2)))
    pieces: list[tuple[list[str], np.ndarray]] = []
    dice = np.random.default_rng(7)
    for words, label in tokens:
        marks = np.array([label and any(f in seeds for f in word_features(word)) for word in words], bool)
        centres = np.flatnonzero(marks)[:20] if marks.any() else dice.integers(0, max(1, len(words)), min(2, len(words)))
        if label and not marks.any():
            continue  # nothing tells which of its words is toxic
        for centre in centres:
            low = max(0, centre - CONTEXT)
            pieces.append((words[low : centre + CONTEXT + 1], marks[low : centre + CONTEXT + 1]))
    if pieces and any(marks.any() for _, marks in pieces):
        _ascend(model, pieces, rounds)
    _calibrate(model, tokens)
    return model


def _expected(evidence: np.ndarray, present: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of the toxic state at each word of the pieces, and the sum of expected transitions."""
    size, width = evidence.shape
    factor = np.exp(np.clip(evidence, -LIMIT, LIMIT))
    forward, backward = np.ones((width, size, 2)), np.ones((width, size, 2))
    local = np.stack([np.ones_like(factor), factor], axis=2).transpose(1, 0, 2)
    live = present.T[:, :, None]
    forward[0] = local[0]
    for t in range(1, width):
        forward[t] = np.where(live[t], (forward[t - 1] @ move) * local[t], forward[t - 1])
        forward[t] /= forward[t].sum(axis=1, keepdims=True)
    for t in range(width - 2, -1, -1):
        backward[t] = np.where(live[t + 1], (local[t + 1] * backward[t + 1]) @ move.T, backward[t + 1])
        backward[t] /= backward[t].sum(axis=1, keepdims=True)
    both = forward * backward
    toxic = (both[:, :, 1] / both.sum(axis=2)).T * present
    joint = forward[:-1, :, :, None] * move * (local[1:] * backward[1:])[:, :, None, :]
    joint /= joint.sum(axis=(2, 3), keepdims=True)
    return toxic, (joint * present[:, 1:].T[:, :, None, None]).sum(axis=(0, 1))


def _ascend(model: Field, pieces: list[tuple[list[str], np.ndarray]], rounds: int) -> None:
    """AdaGrad on the likelihood: observed minus expected counts of features and transitions."""
    width = 2 * CONTEXT + 1
    present = np.zeros((len(pieces), width), bool)
    truth = np.zeros((len(pieces), width))
    features, owners = array("i"), array("i")
    buckets: dict[str, list[int]] = {}
    for n, (words, marks) in enumerate(pieces):
        present[n, : len(words)] = True
        truth[n, : len(words)] = marks
        for t, word in enumerate(words):
            if word not in buckets:
                buckets[word] = [bucket(f) for f in word_features(word)]
            features.extend(buckets[word])
            owners.extend([n * width + t] * len(buckets[word]))
    used, column = np.unique(np.frombuffer(features, np.int32), return_inverse=True)
    owner = np.frombuffer(owners, np.int32)
    weights = np.zeros(len(used) + 5)  # features, bias, four transitions
    weights[len(used)] = model.bias
    seen = np.full(len(weights), 1e-6)
    pairs = present[:, 1:]
    observed = [((truth[:, :-1] == a) & (truth[:, 1:] == b) & pairs).sum() for a in (0, 1) for b in (0, 1)]
    for _ in range(rounds):
        e = np.bincount(owner, weights[column], minlength=present.size).reshape(present.shape) + weights[len(used)]
        move = np.exp(weights[-4:].reshape(2, 2))
        toxic, expected = np.zeros(present.shape), np.zeros((2, 2))
        for low in range(0, len(pieces), BLOCK):
            some = slice(low, low + BLOCK)
            toxic[some], joint = _expected(e[some], present[some], move)
            expected += joint
        expected = expected.ravel()
        miss = (truth - toxic) * present
        gradient = np.concatenate(
            [np.bincount(column, miss.ravel()[owner], minlength=len(used)), [miss.sum()], np.array(observed) - expected]
        )
        gradient -= 0.05 * weights
        seen += gradient**2
        weights += 0.5 * gradient / np.sqrt(seen)
        # A word without features has the bias alone. However few words the sample holds, it must not pass the state on.
        weights[-1] = min(weights[-1], weights[-4] - weights[len(used)] - UNSEEN_COST)
    model.weights[used] = weights[: len(used)]
    model.bias = float(weights[len(used)])
    model.moves = weights[-4:].reshape(2, 2)


def _calibrate(model: Field, tokens: list[tuple[list[str], int]]) -> None:
    """Logistic regression of the labels on what the marginals of the whole documents say."""
    found = []
    for low in range(0, len(tokens), 100):
        marginals = model.marginals([model.evidence(words) for words, _ in tokens[low : low + 100]])
        found += [document_signs(m) for m in marginals]
    x = np.array(found).reshape(-1, 2)
    y = np.array([label for _, label in tokens], float)
    if not len(y) or y.min() == y.max():
        base = 0.0 if not len(y) else (LIMIT if y[0] else -LIMIT)
        model.document = (0.0, 0.0, base if len(y) else -LIMIT)
        return
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(3)
    for _ in range(30):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ w, -LIMIT, LIMIT)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), x.T @ (y - p) - 0.1 * w)
    model.document = tuple(map(float, w))


def sample_of(docs: DataFrame, labels: DataFrame, documents: int, characters: int) -> list[tuple[str, int]]:
    """(text, label) of at most so many documents of each label, none longer than ``characters``; which ones depends on
    a hash of the id alone. They are chosen by ids and hashes, so that only the chosen texts go to the driver."""
    short = docs.filter(F.length("text") <= characters).withColumn("text_id", F.xxhash64("text"))
    rows = short.select("doc_id", "text_id").join(labels, "doc_id").distinct()
    chosen = None
    for label in (0, 1):
        order = [F.xxhash64("doc_id"), "doc_id", "text_id"]
        some = rows.filter(F.col("label") == label).orderBy(*order).limit(documents)
        chosen = some if chosen is None else chosen.unionByName(some)
    found = short.join(F.broadcast(chosen), ["doc_id", "text_id"]).select("text", "label").distinct()
    return [(r["text"], int(r["label"])) for r in found.toLocalIterator()]


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_characters: int = SAMPLE_CHARACTERS,
) -> DataFrame:
    """Each document with doc_id, score, predicted and spans (start, stop, probability) of toxic words.

    Fitted on a bounded sample of the documents that ``labels`` (of ids and 0 or 1) names; NULL labels are left out.
    Scores come from whole texts and from nothing else. NULL texts count as empty and score low; repeated rows and NULL
    ids come out as they come in; an empty table gives no rows. Without labels of both kinds the score is that of the
    one kind, or low.
    """
    rows = texts(docs, id_col, text_col)
    marked = labels.select(named(id_col).alias("doc_id"), named(label_col).alias("label")).filter("label IS NOT NULL")
    return score(rows, fit(sample_of(rows, marked, sample_documents, sample_characters)))


SPAN = "array<struct<start:int,stop:int,probability:double>>"


def score(rows: DataFrame, model: Field) -> DataFrame:
    """Documents (doc_id, text) scored by a fitted field."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(model)  # 2 MB of weights, whatever the data

    def spans(text: str, found: np.ndarray) -> list[dict]:
        if not len(found) or found.max() < 0.5:
            return []
        hits = zip(TOKEN.finditer(text), found)
        return [{"start": m.start(), "stop": m.end(), "probability": float(p)} for m, p in hits if p >= 0.5]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field_ = shared.value
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("probability", pa.float64())]))
        for batch in batches:
            some = batch.column("text").to_pylist()
            found = field_.marginals([field_.evidence(TOKEN.findall(text)) for text in some])
            scores = [field_.score(m) for m in found]
            columns = [
                batch.column("doc_id"),
                pa.array(scores, pa.float64()),
                pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                pa.array([spans(text, m) for text, m in zip(some, found)], span),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted", "spans"])

    return rows.mapInArrow(each, f"doc_id {kind}, score double, predicted int, spans {SPAN}")
