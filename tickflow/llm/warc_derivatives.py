"""Derivatives of web responses: linked metadata and plain-text conversion records in WARC form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import named
from tickflow.llm.html_layout import rendered

END = "\r\n"
#: Time of the records unless the caller says another.
DATE = "1970-01-01T00:00:00Z"


def record_id(*parts: Column) -> Column:
    """The same for the same source on every run, so that a repeated task names the same record."""
    digest = F.md5(F.concat_ws("\n", *parts))
    cut = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages as responses: page_id, response_id, target_uri, http_headers, payload. Control characters, which would end
    a header line, are left out of the address."""
    url = F.regexp_replace(F.coalesce(named(url_col), F.lit("")), r"[\x00-\x1F\x7F]", "").alias("target_uri")
    page = named(id_col).alias("page_id")
    payload = F.coalesce(named(html_col), F.lit("")).alias("payload")
    rows = pages.select(page, url, payload)
    headers = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.octet_length("payload").cast("string"),
    )
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    rows = rows.withColumn("response_id", record_id(F.lit("response"), key, F.col("target_uri"), F.sha2("payload", 256)))
    return rows.withColumn("http_headers", headers)


def derivatives(found: DataFrame, date: str = DATE) -> DataFrame:
    """Two records per response: page_id, record_type, record_id, refers_to, target_uri, content_type, block,
    block_digest, payload_digest (of the source) and record (headers, block and end, as written to a file).

    The metadata record holds the source's HTTP headers and digest and names the conversion; the conversion holds the
    visible text. Both refer to the response. ``date`` is given, not taken from the clock, so that a repeated task writes
    the same records. An empty response gives an empty conversion; equal responses are one response, whose records come
    out as often as it does. An empty table gives no rows.
    """
    carried = F.struct("page_id", "response_id", "target_uri", "http_headers")
    packed = found.select(carried.alias("page_id"), F.col("payload").alias("html"))
    rows = rendered(packed).select("page_id.*", "html", "text")
    rows = rows.withColumns(
        {
            "payload_digest": digest(F.col("html")),
            "conversion_id": record_id(F.lit("conversion"), F.col("response_id")),
            "metadata_id": record_id(F.lit("metadata"), F.col("response_id")),
        }
    )
    fields = F.concat(
        F.lit("derived-conversion: "), F.col("conversion_id"),
        F.lit(f"{END}source-payload-digest: "), F.col("payload_digest"),
        F.lit(f"{END}source-http-headers:{END} "), F.regexp_replace("http_headers", "\r\n", "\r\n "), F.lit(END),
    )

    def record(name: str, key: str, content_type: str, block: Column) -> Column:
        return F.struct(
            F.lit(name).alias("record_type"), F.col(key).alias("record_id"),
            F.lit(content_type).alias("content_type"), block.alias("block"),
        )

    both = F.array(
        record("metadata", "metadata_id", "application/warc-fields", fields),
        record("conversion", "conversion_id", "text/plain; charset=utf-8", F.col("text")),
    )
    rows = rows.select("page_id", "response_id", "target_uri", "payload_digest", F.explode(both).alias("r"))
    rows = rows.select(
        "page_id", "r.record_type", "r.record_id", F.col("response_id").alias("refers_to"), "target_uri",
        "r.content_type", "r.block", digest(F.col("r.block")).alias("block_digest"), "payload_digest",
    )
    lines = [("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
             ("WARC-Target-URI", "target_uri"), ("WARC-Block-Digest", "block_digest"),
             ("WARC-Source-Payload-Digest", "payload_digest"), ("Content-Type", "content_type")]
    head = [F.lit(f"WARC-Date: {date}{END}")]
    head += [F.concat(F.lit(f"{name}: "), F.col(column), F.lit(END)) for name, column in lines]
    size = F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit(END + END))
    return rows.withColumn("record", F.concat(F.lit(f"WARC/1.1{END}"), *head, size, F.col("block"), F.lit(END + END)))
