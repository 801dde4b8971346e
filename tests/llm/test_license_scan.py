import time

from tickflow.llm.license_scan import TEMPLATES, Index, license_matches, tokens


def test_every_template_is_found_whole_and_with_a_word_changed():
    index = Index(TEMPLATES)
    for name, text in TEMPLATES.items():
        whole = "Some words before it. " * 30 + text + " And some after."
        found = {m[0]: m for m in index.scan(whole, 0.8)}
        assert found[name][4] == 1.0
        assert whole[found[name][1] : found[name][2]].startswith(text[:8])
    changed = TEMPLATES["MIT-permission"].replace("associated", "related")
    assert [m[0] for m in index.scan(changed, 0.8)] == ["MIT-permission"]
    assert index.scan("Nothing is licensed here under any terms. " * 50, 0.8) == []


def test_hard_rows(docs_of):
    mit = TEMPLATES["MIT"]
    docs = docs_of([(1, mit), (1, mit), (None, mit + " x. " + mit), (2, None), (3, ""), (4, "a " * 100_000 + mit)])
    rows = license_matches(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "4", "None", "None"]
    assert license_matches(docs.limit(0)).count() == 0 and license_matches(docs, {}).count() == 0


def test_long_rule_lines_take_linear_time(docs_of):
    start = time.perf_counter()
    rows = [(1, "a" + "-" * 300_000 + " Released under the MIT License. " + "." * 300_000), (2, "-+. " * 100_000)]
    found = license_matches(docs_of(rows)).collect()
    assert [(r.doc_id, r.license) for r in found] == [(1, "MIT")] and time.perf_counter() - start < 20


def _common_words(one, other):
    """Longest common subsequence, without a band."""
    row = [0] * (len(other) + 1)
    for a in one:
        above, row = row, [0]
        for n, b in enumerate(other):
            row.append(above[n] + 1 if a == b else max(above[n + 1], row[n]))
    return row[-1]


def test_recall_of_notices_with_one_word_changed_left_out_or_added():
    """Against alignment of all words; misses are in notices of five to seven words, where no fingerprint is left."""
    index, found, there = Index(TEMPLATES), 0, 0
    for name, text in TEMPLATES.items():
        words = text.split()
        for at in range(len(words)):
            for altered in (["zzq"], [], ["zzq", words[at]]):
                notice = " ".join([*words[:at], *altered, *words[at + 1 :]])
                template = tokens(text)[0]
                if _common_words(template, tokens(notice)[0]) >= 0.8 * len(template):
                    there += 1
                    matches = index.scan(f"some words come first. {notice} and after it", 0.8)
                    found += name in {match[0] for match in matches}
    assert there > 200 and found >= 0.9 * there
