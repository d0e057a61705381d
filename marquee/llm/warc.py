"""WARC derivatives: metadata and plain-text conversion records made from response records.

A response gives two records.  The *metadata* record (application/warc-fields)
holds title, language, status, links and digests; the *conversion* record is the
page's text.  Both refer to the response by its id, keep its target and
date, and carry the source's HTTP headers and payload digest; the metadata
record also names the conversion made along with it.  Ids are derived from the source's id,
so a second run makes the same records.  Everything is SQL functions; rows are
independent of each other, and nothing is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matches import rewritten

CRLF = "\r\n"
BREAKS = ("address|article|aside|blockquote|br|dd|div|dl|dt|figcaption|footer|form|h[1-6]|header|hr|li|main|nav|ol|option|p|pre"
          "|section|table|td|th|title|tr|ul")
# applied one after the other; RE2 and Java read them alike
CONVERSION = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b[^>]*>.*?</script\s*>", ""),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", ""),
    (rf"(?i)</?(?:{BREAKS})\b[^>]*>", "\n"),
    (r"</?[A-Za-z!?][^>]*>", ""),
    (r"&nbsp;", " "), (r"&lt;", "<"), (r"&gt;", ">"), (r"&quot;", '"'), (r"&#39;", "'"), (r"&apos;", "'"), (r"&amp;", "&"),
    # runs that are one blank, or one line end, already are left where they are
    (r"[\t\r\f][ \t\r\f]*| [ \t\r\f]+", " "),
    (r" \n[ \n]*|\n[ \n]+", "\n"),
    (r"^[ \n]+|[ \n]+$", ""),
]
NUMBER = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"


def record_id(name: Column) -> Column:
    """<urn:uuid:...> from the MD5 of a name."""
    h = F.md5(name)
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def _character(reference: Column) -> Column:
    """The character of a numeric reference; what is no character stays as it is."""
    body = F.regexp_extract(reference, "&#(.*);", 1)
    code = F.when(body.rlike("^[xX]"), F.conv(F.substr(body, F.lit(2)), 16, 10)).otherwise(body).cast("long")
    fine = (code >= 32) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(fine, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(reference)


def plain_text(html: Column) -> Column:
    """The text of a page: markup, scripts, styles and comments gone, blocks on lines, references resolved."""
    out = html
    for pattern, new in CONVERSION[:5]:
        out = F.regexp_replace(out, pattern, new)
    out = rewritten(out, NUMBER, _character, "&#")
    for pattern, new in CONVERSION[5:]:
        out = F.replace(out, F.lit(pattern), F.lit(new)) if pattern[0] == "&" else F.regexp_replace(out, pattern, new)
    return out


def pages_as_responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages (page_id, url, html); a null page is an empty payload."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(html).cast("string"))
    name = F.concat_ws(" ", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce("url", F.lit("-")))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), record_id(name).alias("record_id"),
                        F.col("url").cast("string").alias("target_uri"), F.lit(date).alias("warc_date"),
                        F.concat(head, F.lit(CRLF * 2), html).alias("block"))


def derive(responses: DataFrame, key: str = "page_id") -> DataFrame:
    """Two records for every response (``key``, record_id, target_uri, warc_date, block).

    Columns: the key, warc_type, record_id, refers_to, concurrent_to,
    target_uri, refers_to_date, content_type, source_headers, payload_digest
    (of the source), block_digest, content_length, block.

    A null block is an empty one; a block without an empty line is all
    headers.  Empty payloads give empty conversions, so every response has both
    records.  Repeated rows give repeated records.
    """
    blank = CRLF * 2
    block = F.coalesce(F.col("block").cast("string"), F.lit(""))
    head = F.substring_index(block, blank, 1)
    parts = responses.select(
        F.col(key), "record_id", "target_uri", "warc_date", head.alias("source_headers"),
        F.when(F.contains(block, F.lit(blank)), F.substr(block, F.length(head) + len(blank) + 1)).otherwise("").alias("payload"))
    parts = parts.withColumns({"payload_digest": digest(F.col("payload")), "text": plain_text(F.col("payload"))})
    made = {kind: record_id(F.concat_ws(" ", F.lit(kind), F.coalesce("record_id", F.lit("-")))) for kind in ("metadata", "conversion")}

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), F.coalesce(value, F.lit("")), F.lit(CRLF))

    links = F.size(F.regexp_extract_all("payload", F.lit(r"(?i)<a\s[^>]*href="), F.lit(0)))
    title = F.trim(F.regexp_replace(F.regexp_extract("payload", r"(?is)<title[^>]*>(.*?)</title\s*>", 1), r"\s+", " "))
    fields = [field("status", F.regexp_extract("source_headers", r"^HTTP/[0-9.]+ ([0-9]{3})", 1)),
              field("source-content-type", F.regexp_extract("source_headers", r"(?i)content-type:[ \t]*([^\r\n]*)", 1)),
              field("title", title), field("language", F.regexp_extract("payload", r"(?i)<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1)),
              field("links", links.cast("string")), field("payload-digest", F.col("payload_digest")),
              field("text-digest", digest(F.col("text")))]

    def record(kind: str, other: Column, content_type: str, body: Column) -> Column:
        return F.struct(F.lit(kind).alias("warc_type"), made[kind].alias("record_id"), other.alias("concurrent_to"),
                        F.lit(content_type).alias("content_type"), body.alias("block"))

    records = F.array(record("metadata", made["conversion"], "application/warc-fields", reduce(F.concat, fields)),
                      record("conversion", made["metadata"], "text/plain", F.col("text")))
    return parts.select(F.col(key), F.col("record_id").alias("refers_to"), "target_uri", F.col("warc_date").alias("refers_to_date"),
                        "source_headers", "payload_digest", F.explode(records).alias("r")).select(
        key, "r.warc_type", "r.record_id", "refers_to", "r.concurrent_to", "target_uri", "refers_to_date", "r.content_type",
        "source_headers", "payload_digest", digest(F.col("r.block")).alias("block_digest"),
        F.octet_length("r.block").cast("long").alias("content_length"), "r.block")


def serialised() -> Column:
    """One record of ``derive`` as WARC/1.1 text, with its empty lines."""
    def line(name: str, value: str) -> Column:
        return F.when(F.col(value).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(value).cast("string"), F.lit(CRLF))).otherwise("")

    names = [("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
             ("WARC-Concurrent-To", "concurrent_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "refers_to_date"),
             ("WARC-Refers-To-Date", "refers_to_date"), ("WARC-Source-Payload-Digest", "payload_digest"),
             ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), *(line(*x) for x in names), F.lit(CRLF), F.col("block"), F.lit(CRLF * 2))
