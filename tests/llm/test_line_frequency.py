import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tickflow.llm.line_frequency import base_signals, keep_good_documents, line_verdicts
from tickflow.llm.common import texts

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def signals(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x y   z\x85w", "l\nl\n\nl \n|#<a>",
    "one two three\nfour one two three five " * 30, "é ü\n" * 5, " ".join(f"w{i}" for i in range(20_000)) + " w1 w2 w3",
]


def test_signals_equal_brute_force(docs_of):
    rows = base_signals(texts(docs_of(list(enumerate(TEXTS))))).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == signals(TEXTS[r.doc_id])


def verdicts(rows, min_documents=20, max_percent=1, min_left=20, min_left_percent=30):
    """By the definition, from (doc_id, text, host): for each row its kept and left_words."""
    lines = [[" ".join(WORDS.findall(x.lower())) for x in (t or "").split("\n") if WORDS.search(x)] for _, t, _ in rows]
    holders, hosts = defaultdict(set), defaultdict(set)
    for (_, text, host), own in zip(rows, lines):
        hosts[host].add(text or "")
        for one in own:
            holders[host, one].add(text or "")
    frequent = {k for k, v in holders.items() if len(v) > min_documents and 100 * len(v) > max_percent * len(hosts[k[0]])}
    out = []
    for (doc_id, text, host), own in zip(rows, lines):
        n, _, _, _, repeats = signals(text)
        left = n - sum(len(one.split(" ")) for one in own if (host, one) in frequent)
        kept = n >= 50 and 100 * repeats <= 50 * n and left >= min_left and 100 * left >= min_left_percent * n
        out.append((doc_id, n, left, kept))
    return sorted(out, key=repr)


def line(i, k, n=12):
    return " ".join(f"d{i}l{k}w{j}" for j in range(n))


def corpus():
    """30 documents of own lines and a shared one, 30 mostly of long shared lines, 40 copies and 15 near copies."""
    shared = [line("s", k, 60) for k in range(3)]
    own = [(i, "\n".join([line(i, k) for k in range(5)] + shared[:1])) for i in range(30)]
    thin = [(100 + i, "\n".join(shared + [line(i + 100, k, 2) for k in range(12)])) for i in range(30)]
    copied = [line("c", k) for k in range(8)]
    copies = [(200 + i, "\n".join(copied)) for i in range(40)]
    near = [(300 + i, "\n".join(copied + [line(f"v{i}", 0, 3)])) for i in range(15)]
    return own + thin + copies + near


def test_depleted_documents_go_and_copies_stay(docs_of):
    rows = {r.doc_id: r for r in line_verdicts(docs_of(corpus()), min_documents=20).collect()}
    assert all(rows[i].kept and rows[i].left_words == 60 for i in range(30))
    assert not any(rows[i].kept for i in range(100, 130)) and all(rows[i].left_words == 24 for i in range(100, 130))
    copies = [*range(200, 240), *range(300, 315)]
    assert all(rows[i].kept and rows[i].left_words == rows[i].n_words for i in copies)


def test_many_shared_lines_are_all_found(docs_of):
    shared = [line("s", k, 8) for k in range(20)]
    rows = [(i, "\n".join([*shared, line(i, 0, 6), line(i, 1, 6)])) for i in range(100)]
    found = line_verdicts(docs_of(rows)).collect()
    assert len(found) == 100 and not any(r.kept for r in found) and {r.left_words for r in found} == {12}


def test_verdicts_equal_brute_force(docs_of, spark):
    dice = random.Random(5)
    pool = [" ".join(f"p{k}w{j}" for j in range(dice.randrange(3, 30))) for k in range(40)]
    rows = []
    for i in range(700):
        parts = [dice.choice(pool[: dice.choice((3, 40))]) for _ in range(dice.randrange(0, 8))]
        parts += [line(i, k, dice.randrange(2, 30)) for k in range(dice.randrange(0, 4))]
        dice.shuffle(parts)
        parts = [dice.choice((str.upper, str.title, lambda x: f" {x}  ", lambda x: x.replace(" ", "\t "))) (x) for x in parts]
        rows.append((i, "\n".join(parts), dice.choice(("a", "a", "b", None))))
    rows += [(1_000 + i, *rows[i][1:]) for i in range(50)] + rows[:3] + [(None, None, "a"), (5_000, "", "b"), (5_001, "\n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string").repartition(5)
    found = line_verdicts(docs, host_col="host", max_percent=2.5)
    expected = verdicts(rows, max_percent=2.5)
    assert 50 < sum(r[3] for r in expected) < 650 and sum(r[1] != r[2] for r in expected) > 100
    assert sorted(map(tuple, found.select("doc_id", "n_words", "left_words", "kept").collect()), key=repr) == expected


def test_kept_documents_lose_their_frequent_lines(docs_of):
    rows = corpus() + [(None, None), (None, line("x", 1, 60)), (7_000, ""), corpus()[0]]
    docs = docs_of(rows).withColumns({"judged_id": F.lit(1), "Judged_Text": F.lit("t"), "removed": F.lit(2), "n_chars": F.lit(0)})
    left = keep_good_documents(docs)
    assert left.columns == docs.columns
    found = Counter((r.doc_id, r.text, r.judged_id, r.Judged_Text, r.removed, r.n_chars) for r in left.collect())
    expected = Counter()
    for doc_id, text in rows:
        if doc_id is None and text or doc_id is not None and (doc_id < 30 or 200 <= doc_id < 7_000):
            text = "\n".join(text.split("\n")[:5]) if doc_id is not None and doc_id < 30 else text
            expected[doc_id, text, 1, "t", 2, len(text)] += 1
    assert found == expected
    assert keep_good_documents(docs_of([])).count() == 0


def test_long_and_empty_lines(docs_of):
    long = "w " * 150_000
    rows = [(i, f"{long}\n{line(i, 0, 60)}\n \t\n\n") for i in range(3)] + [(i, "\n" * 5_000) for i in range(3, 6)]
    found = sorted(map(tuple, line_verdicts(docs_of(rows), min_documents=2).select("doc_id", "n_words", "left_words").collect()))
    assert found == [(i, 150_060, 60) for i in range(3)] + [(i, 0, 0) for i in range(3, 6)]


def test_repeated_rows_nulls_and_empty_tables(docs_of):
    docs = docs_of(corpus() + corpus()[:3] + [(None, None), (None, line("x", 1, 60)), (7_000, "")])
    docs = docs.withColumn("source", F.when(F.col("doc_id") != 1, F.col("source")))
    rows = line_verdicts(docs).collect()
    assert len(rows) == 121
    by = defaultdict(set)
    for r in rows:
        by[(r.doc_id, r.n_words)].add((r.left_words, r.kept))
    assert all(len(v) == 1 for v in by.values()) and by[(None, 60)] == {(60, True)} and by[(7000, 0)] == {(0, False)}
    assert line_verdicts(docs_of([])).count() == 0
