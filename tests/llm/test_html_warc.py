import hashlib
import time
from datetime import datetime

import pytest

from tickflow.llm.html_layout import rendered, visible_text
from tickflow.llm.warc_derivatives import derivatives, responses


def test_blocks_lists_tables_and_visibility():
    assert visible_text("<head><title>x</title></head><p>a  b<p>c<script>d</script>") == "a b\n\nc"
    assert visible_text("<ol><li>a<li>b</ol>") == "1. a\n2. b"
    assert visible_text("<table><tr><td>a<td>b<tr><td>long<td>c</table>") == "a     b\nlong  c"
    assert visible_text("<div hidden>a</div><div style='display:none'>b</div>c") == "c"
    assert visible_text("") == ""
    assert visible_text("<div>" * 5000 + "deep") == "deep"


def test_records_refer_to_their_source(spark):
    schema = "page_id long, url string, html string, text string"
    pages = spark.createDataFrame([(1, "u", "<p>a", "x"), (None, None, None, None)], schema)
    assert rendered(pages).count() == 2
    rows = derivatives(responses(pages)).collect()
    assert len(rows) == 4 and len({r.record_id for r in rows}) == 4 and len({r.refers_to for r in rows}) == 2
    for row in rows:
        assert row.block_digest == "sha256:" + hashlib.sha256(row.block.encode()).hexdigest()
        assert row.record.split("\r\n\r\n", 1)[1] == row.block + "\r\n\r\n"
    assert derivatives(responses(pages.limit(0))).count() == 0


def test_layout():
    assert visible_text("<p>t<pre>a\nb</pre>u") == "t\n\na\nb\n\nu"
    assert visible_text("<pre>\n a\n\n  b</pre>") == " a\n\n  b"
    assert visible_text("a<br><br>b &amp; &lt;c") == "a\n\nb & <c"
    assert visible_text("<ol start=4><li>a<li value=9>b<li>c</ol>") == "4. a\n9. b\n10. c"
    assert visible_text("<ul><li><p>a</p><li>b<ul><li>c</ul></ul>") == "- a\n\n- b\n  - c"
    assert visible_text("<div style='visibility:hidden'>a<b style='visibility: visible'>b</b>c</div>d") == "b\nd"
    table = "<table><tr><th colspan=2>wide heading<th>x<tr><td rowspan=2>a<td>bb<td>c<tr><td>d<td>e</table>"
    assert visible_text(table) == "wide heading  x\na  bb  c\n   d   e"
    assert visible_text("<table><tr><td><ul><li>a<li>b</ul><td>c</table>") == "- a  c\n- b"
    assert visible_text("<table><tr><td>x<table><tr><td>1<td>2</table><td>y</table>") == "x     y\n1  2"
    assert visible_text("a<!-- b > c -->d<!-->e<!DOCTYPE f><![foo[x]]>g<?h?>i</>j<1 k") == "adegij<1 k"
    assert visible_text("<script>if (a < b) '</p>'</script>c<style>d</style >e<title>f</title>g") == "ceg"
    assert visible_text("<a href='x>y' title=\"a'b\" hidden>z</a><a =b c=d>e</a>f") == "ef"


HOSTILE = [
    "<table><tr><td>" * 3_000 + "x", "<![foo[x]]>" * 20_000, "<!--" * 100_000, "<a " * 100_000, "<a b=\"" * 50_001,
    "<" * 300_000, "</" * 100_000 + ">", "<b>" * 50_000 + "<td>" + "<i>" * 50_000 + "</b>" * 50_000,
    "<ul><li>" * 30_000 + "x", "<li>" * 100_000, "<p " + " " * 300_000 + "=" * 1_000 + ">x", "&" * 300_000, "<title>" * 50_000,
    "<table>" + "<tr><td rowspan=9999>x" * 2_000, "<table><tr>" + "<td colspan=9999>x" * 5_000, "<div>" * 100_000 + "</p>" * 100_000,
]


@pytest.mark.parametrize("number", range(len(HOSTILE)))
def test_hostile_pages_end_soon(number):
    start = time.perf_counter()
    text = visible_text(HOSTILE[number])
    assert time.perf_counter() - start < 15 and len(text) < 20 * len(HOSTILE[number])


def test_one_long_cell_does_not_widen_its_column():
    page = "<table>" + "<tr><td>a<td>b" * 5_000 + f"<tr><td>{'w' * 50_000}<td>c</table>"
    lines = visible_text(page).split("\n")
    assert lines[:5_000] == ["a  b"] * 5_000 and lines[5_000] == "w" * 50_000 + "  c"


def parsed(record):
    """Headers and block of a record, read as a reader of the format does."""
    head, rest = record.encode().split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    assert version == "WARC/1.1" and len(headers) == len(lines) and rest[size:] == b"\r\n\r\n"
    return headers, rest[:size]


def test_records_can_be_read_back(spark):
    when = datetime(2024, 5, 6, 7, 8, 9, 123456)
    rows = [(when, "http://a/\r\nWARC-Type: x", "<p>é b<p>c", "x"), (when, "u", "", "y"), (None, None, None, None)]
    rows += [rows[0], (when, "v" * 100_000, "<p>" + "word " * 100_000, "z")]
    pages = spark.createDataFrame(rows, "page_id timestamp, url string, html string, payload string")
    found = derivatives(responses(pages), "2024-01-02T03:04:05Z").collect()
    assert len(found) == 10 and {r.page_id for r in found} == {when, None}
    by_id = {}
    for r in found:
        headers, block = parsed(r.record)
        assert headers["WARC-Date"] == "2024-01-02T03:04:05Z" and headers["WARC-Type"] == r.record_type
        assert headers["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        assert headers["WARC-Refers-To"] == r.refers_to and headers["WARC-Record-ID"] == r.record_id
        by_id[r.record_id] = (r, block)
    assert len(by_id) == 8
    for r, block in by_id.values():
        if r.record_type == "metadata":
            fields = dict(line.split(": ", 1) for line in block.decode().split("\r\n") if ": " in line and line[0] != " ")
            assert by_id[fields["derived-conversion"]][0].refers_to == r.refers_to
            assert fields["source-payload-digest"] == r.payload_digest
    sources = {"sha256:" + hashlib.sha256((html or "").encode()).hexdigest(): html or "" for _, _, html, _ in rows}
    for r, block in by_id.values():
        if r.record_type == "conversion":
            assert block.decode() == visible_text(sources[r.payload_digest])
