import hashlib
import random
import re

from pyspark.sql import functions as F

from tickflow.llm.exact_dedup import drop_exact_copies, exact_groups


def expected(rows):
    spaced = {(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows}
    counts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = set()
    for i, t in spaced:
        ids = [j for j, u in spaced if u == t and j is not None]
        keep = min(ids, default=None)
        out.add((i, keep, counts.count(t), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return out


def rows_of(frame):
    return [tuple(r) for r in frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]


ROWS = [(3, "a b"), (1, "a \n b"), (7, None), (5, ""), (9, " "), (2, "a b "), (None, "a b"), (None, "z"), (4, "é" * 50_000)]


def test_groups(docs_of):
    found = rows_of(exact_groups(docs_of(ROWS)))
    assert len(found) == len(set(found)) and set(found) == expected(ROWS)


def test_repeated_rows_are_one_document(docs_of):
    rows = [(1, "x"), (1, "x"), (1, "y"), (2, "x")]
    found = rows_of(exact_groups(docs_of(rows)))
    assert len(found) == 3 and set(found) == expected(rows)
    kept = drop_exact_copies(docs_of(rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "x"), (1, "y")]
    assert kept.columns == docs_of(rows).columns


def test_collisions_of_the_hash_are_told_apart(docs_of):
    dice = random.Random(1)
    rows = [(i, f"text {dice.randrange(40)}") for i in range(200)] + [(None, "text 3"), (500, None)]
    weak = exact_groups(docs_of(rows), hashed=lambda t: F.substring(F.md5(t), 1, 1))
    found = rows_of(weak)
    assert len(found) == 202 and set(found) == expected(rows)


def test_empty_table_and_other_names(docs_of):
    assert exact_groups(docs_of([])).count() == 0
    named = docs_of([(1, "a"), (2, "a")]).withColumnsRenamed({"doc_id": "n.o", "text": "body"})
    assert drop_exact_copies(named, "n.o", "body").count() == 1


def test_stages_keep_columns_whatever_their_names(docs_of):
    from pyspark.sql import functions as F

    from tickflow.llm.exact_dedup import drop_exact_copies
    from tickflow.llm.simhash_golay import drop_near_copies

    text = " ".join(f"w{i}" for i in range(40))
    docs = docs_of([(1, text), (2, text), (3, text + " more"), (1, text), (None, None), (7, "")])
    docs = docs.withColumns({"dedup_id": F.lit(5), "Dedup_Text": F.lit(6), "kept_id": F.lit(7)})
    for stage, left in ((drop_exact_copies, [1, 3, 7]), (drop_near_copies, None)):
        found = stage(docs)
        assert found.columns == docs.columns
        rows = found.collect()
        assert all((r.dedup_id, r.Dedup_Text, r.kept_id) == (5, 6, 7) for r in rows)
        assert left is None or sorted(r.doc_id for r in rows) == left
        assert stage(docs_of([]).withColumns({"dedup_id": F.lit(5), "kept_id": F.lit(7)})).count() == 0
