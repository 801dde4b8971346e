from itertools import product

import numpy as np
import pytest

from tickflow.llm.crf_toxicity import Field, fit, score, toxicity
from tickflow.llm.queries import op2_crf_toxicity


def test_marginals_equal_all_paths():
    dice = np.random.default_rng(1)
    model = Field(np.zeros(1), 0.0, dice.normal(size=(2, 2)))
    evidence = [dice.normal(size=n) for n in (5, 0, 1, 7, 3, 7)]
    for e, found in zip(evidence, model.marginals(evidence)):
        total, toxic = 0.0, np.zeros(len(e))
        for path in product((0, 1), repeat=len(e)):
            weight = np.exp(sum(e[t] for t in range(len(e)) if path[t]) + sum(model.moves[a, b] for a, b in zip(path, path[1:])))
            total += weight
            toxic += weight * np.array(path)
        assert np.allclose(found, toxic / total) and len(found) == len(e)


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    rows = op2_crf_toxicity(spark, folder)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = [(labels[r.doc_id], r.score, r.predicted) for r in rows.collect() if r.held_out and r.doc_id in labels]
    toxic = [p for y, _, p in found if y]
    clean = [p for y, _, p in found if not y]
    # 350 toxic documents to learn from: too few for the rare words of three of the four languages.
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.01 * len(clean)


@pytest.fixture(scope="module")
def small():
    clean = [(f"quite ordinary words number {i % 7} stand here and there", 0) for i in range(60)]
    toxic = [(f"ordinary words with an ugly{i % 3} Uglyness of kind here and there", 1) for i in range(40)]
    return clean + toxic


def test_spans_nulls_and_empty_tables(spark, small, docs_of):
    model = fit(small)
    assert model.weights.any() and np.array_equal(model.weights, fit(small[::-1]).weights)
    docs = docs_of([(1, "here is Ugly and there"), (2, None), (3, ""), (None, "ordinary words"), (1, "1 2 3"), (4, "w " * 50_000 + "ugly Uglyness")])
    rows = score(docs.na.fill("").select("doc_id", "text"), model).collect()
    by = {(r.doc_id, len(r.spans)): r for r in rows}
    assert len(rows) == 6 and [(s.start, s.stop) for s in by[1, 1].spans] == [(8, 12)]
    assert by[1, 1].predicted == 1 and by[4, 2].predicted == 1 and by[4, 2].spans[0].start == 100_000
    assert all(by[k].predicted == 0 for k in [(2, 0), (3, 0), (None, 0), (1, 0)])
    labels = spark.createDataFrame([(1, None), (9, 1)], "doc_id long, toxic int")
    assert all(r.predicted == 0 for r in toxicity(docs, labels).collect())
    assert toxicity(docs_of([]), labels).count() == 0


def test_length_and_unseen_words_say_nothing(spark, small, docs_of):
    model = fit(small)
    dice = np.random.default_rng(3)
    unseen = lambda n: " ".join(f"{chr(97 + k % 26)}x{k}" for k in dice.integers(0, 10**6, n))
    rows = [(1, unseen(300)), (2, unseen(50_000)), (3, "quite ordinary words stand here and there " * 8_000)]
    rows += [(4, unseen(20_000) + " ugly1 Uglyness " + unseen(20_000)), (4, rows[0][1]), (5, rows[0][1]), (5, rows[0][1])]
    found = sorted((r.doc_id, r.predicted, len(r.spans), round(r.score, 6)) for r in score(docs_of(rows), model).collect())
    assert [f[:3] for f in found] == [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), (4, 1, 2), (5, 0, 0), (5, 0, 0)]
    assert found[0][3] == found[1][3] == found[2][3] < 0.2
