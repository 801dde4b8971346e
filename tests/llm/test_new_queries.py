"""The queries of periodic runs, SentencePiece ids and resampling, column by column, from their definitions."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece

from test_importance_resampling import brute_force as resampled_by_force
from test_periodic_runs import brute_force as runs_by_force
from tickflow.llm.queries import QUERIES, echoing

TABLES = "/root/testdata/sf0.001"


def documents():
    table = pq.read_table(f"{TABLES}/documents.parquet")
    return list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


def sha(data):
    return hashlib.sha256(data).hexdigest()


def echoed(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_periodic_runs(spark):
    found = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, TABLES).collect()}
    with_runs = 0
    rows = [(i, t) for i, t in documents() if len((t or "").split()) < 1_500]
    assert len(rows) > 150
    for doc_id, text in rows:
        words = echoed(doc_id, (text or "").encode().split())
        runs = runs_by_force(words)
        gone = {k for s, n, p in runs for k in range(s + p, s + n)}
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        r = found[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode())
        assert r.collapsed_sha256 == sha(b" ".join(w for k, w in enumerate(words) if k not in gone))
        with_runs += bool(runs)
    assert with_runs > 5


def test_echoes_of_null_and_empty_texts(spark):
    docs = spark.createDataFrame([(i, t) for i in range(300) for t in (None, "", " \t", "a", "b c")], "doc_id long, text string")
    for r in echoing(docs).collect():
        assert r.text in ("", " \t", "a", "b c", "b b", "c c") and r.text is not None


def test_sentencepiece(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {tuple(r) for r in QUERIES["op12_sentencepiece_backtrack"](spark, TABLES).collect()}
    expected = set()
    for doc_id, text in documents():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        decoded = library.decode(ids).encode()
        expected.add((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded)))
    assert found == expected


def test_resampling(spark):
    target = pq.read_table(f"{TABLES}/benchmark.parquet")["text"].to_pylist()
    expected = [(r[0], *r[2:]) for r in resampled_by_force(documents(), target)]
    found = [tuple(r) for r in QUERIES["op13_importance_resampling"](spark, TABLES).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
