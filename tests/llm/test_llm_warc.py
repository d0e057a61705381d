"""WARC derivatives against a plain reading of the same rules, and odd responses."""

import hashlib
import random
import re

from marquee.llm import warc

BREAKS = warc.BREAKS
PARTS = ["<p>", "</p>", "<br/>", "<DIV class='x'>", "</div >", "<b>", "</b>", "<!-- a > b -->", "<script>var a = '<p>';</script>", "<STYLE>p {}</STYLE >",
         "&amp;", "&lt;", "&nbsp;", "&quot;", "&#39;", "&apos;", "&#65;", "&#x1F600;", "&#xD800;", "&#0;", "&amp;lt;", "<title>A  b\n c</title>",
         "<a href='/x'>", "<html lang=\"de\">", "1 < 2", "é", "one", "two words", " ", "  ", "\t", "\n", " \n", "\n\n ", "\r\n", "\f", "", "end.", "<", ">"]


def text_of(html):
    """The page's text by the rules one after the other, as they are meant."""
    out = re.sub(r"(?s)<!--.*?-->", "", html)
    out = re.sub(r"(?is)<script\b[^>]*>.*?</script\s*>", "", out)
    out = re.sub(r"(?is)<style\b[^>]*>.*?</style\s*>", "", out)
    out = re.sub(rf"(?i)</?(?:{BREAKS})\b[^>]*>", "\n", out)
    out = re.sub(r"</?[A-Za-z!?][^>]*>", "", out)

    def character(m):
        code = int(m[1][1:], 16) if m[1][0] in "xX" else int(m[1])
        return chr(code) if 32 <= code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else m[0]
    out = re.sub(r"&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", character, out)
    for name, new in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        out = out.replace(name, new)
    out = re.sub(r"[ \t\r\f]+", " ", out)
    return re.sub(r" ?\n[ \n]*", "\n", out).strip(" \n")


def sha(text):
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def test_records_equal_a_plain_reading(spark):
    rng = random.Random(16)
    pages = [(i, f"http://h/{i}", "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    pages += [(900, None, None), (901, "http://h/long", "<p>word &amp; more</p>\n" * 40_000), (None, "http://h/n", "<p>x</p>"), (None, "http://h/n", "<p>x</p>")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, block string")
    records = warc.derive(warc.pages_as_responses(df)).collect()
    assert len(records) == 2 * len(pages)
    by_page = {(r.page_id, r.target_uri, r.warc_type): r for r in records}
    for page, url, html in pages:
        html = html or ""
        text = by_page[page, url, "conversion"]
        meta = by_page[page, url, "metadata"]
        assert text.block == text_of(html), html
        assert text.block_digest == sha(text.block) and text.content_length == len(text.block.encode())
        assert text.payload_digest == meta.payload_digest == sha(html)
        assert text.refers_to == meta.refers_to and text.concurrent_to == meta.record_id and meta.concurrent_to == text.record_id
        fields = dict(line.split(": ", 1) for line in meta.block.split("\r\n") if line)
        assert fields["status"] == "200" and fields["payload-digest"] == sha(html) and fields["text-digest"] == sha(text.block)
        assert fields["links"] == str(len(re.findall(r"(?i)<a\s[^>]*href=", html)))
        assert text.source_headers.endswith(f"Content-Length: {len(html.encode())}")


def test_odd_responses(spark):
    kind = "page_id long, record_id string, target_uri string, warc_date string, block string"
    rows = [(1, "<urn:uuid:1>", "u", "d", None), (2, "<urn:uuid:2>", "u", "d", "HTTP/1.1 404 Not Found\r\nX: y"), (3, None, None, None, "\r\n\r\n<p>a</p>")]
    got = {(r.page_id, r.warc_type): r for r in warc.derive(spark.createDataFrame(rows, kind)).collect()}
    assert got[1, "conversion"].block == got[2, "conversion"].block == "" and got[3, "conversion"].block == "a"
    assert got[2, "metadata"].block.startswith("status: 404") and got[2, "conversion"].source_headers == "HTTP/1.1 404 Not Found\r\nX: y"
    assert got[1, "conversion"].refers_to == "<urn:uuid:1>" and got[3, "conversion"].refers_to is None
    assert warc.derive(spark.createDataFrame([], kind)).collect() == []
