"""The corpus pipeline stage by stage against brute force, each stage on what its predecessor kept."""

import re
from collections import defaultdict

import corpus_pipeline
import pyarrow.parquet as pq
from test_line_frequency import verdicts
from test_suffix_dedup import brute_force as passages_by_force
from tickflow.llm.simhash_golay import fingerprint

TABLES = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs, kept = spark.read.parquet(f"{TABLES}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, TABLES)
        assert name == "packing" or rows.columns == columns
        rows.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()

    table = pq.read_table(f"{TABLES}/documents.parquet")
    given = list(zip(*(table[c].to_pylist() for c in ("doc_id", "text", "source"))))
    good = [r.doc_id for r in kept["quality_rules"]]
    assert sorted(good) == [r[0] for r in sorted(verdicts(given)) if r[3]] and len(good) > 100

    first = {}
    for r in sorted(kept["quality_rules"], key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    unique = kept["exact_dedup"]
    assert sorted(r.doc_id for r in unique) == sorted(first.values())

    prints = {r.doc_id: fingerprint(r.text.encode()) for r in unique}
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    near = kept["near_dedup"]
    assert sorted(r.doc_id for r in near) == sorted({top(i) for i in prints})

    left = {r.doc_id: r.text for r in kept["passage_dedup"]}
    assert left.keys() == {r.doc_id for r in near}
    by_force = {r[0]: r for r in passages_by_force([(r.doc_id, r.text) for r in near])}
    texts = {r.doc_id: r.text for r in near}
    for i, text in left.items():
        removed = len(texts[i].encode()) - len(text.encode())
        assert by_force[i][2] - 6 * by_force[i][3] <= removed <= by_force[i][2]

    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in kept["packing"]:
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == left.keys()
    for parts in (sorted(p) for p in pieces.values()):
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:n]) for n in range(len(parts))]
        assert sum(p[1] for p in parts) == parts[0][2]
    for parts in (sorted(s) for s in sequences.values()):
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:n]) for n in range(len(parts))]
        assert sum(p[1] for p in parts) <= 4_096
    assert corpus_pipeline.run(spark, TABLES).count() == len(kept["packing"])
