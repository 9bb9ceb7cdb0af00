import base64
import gzip
import hashlib
import time
from html.parser import HTMLParser

import pytest

from rosband.llm import warc

from .conftest import PAGE

HTML = ("<!DOCTYPE html><html lang='de'><head><title>A  &amp;\n B</title><style>p{}</style><script>var t=\"</p>\";</script></head>"
        "<body><!-- no --><p>one <b>two</b>&nbsp;three<a class=\"x>y\" href='/l?a=1&amp;b=2'>four</a><br>five</p><p>six</body></html>")  # fmt: skip


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_read_page():
    assert warc.read_page(HTML) == ("one two threefour\nfive\nsix", "A & B", "de", ["/l?a=1&b=2"])


@pytest.mark.parametrize("bad", ['<a "', "<", "<!--", "<script>", "</", "<a href=", "<p <p <p"])
def test_malformed_markup_takes_linear_time(bad):
    start = time.process_time()
    warc.read_page(bad * 100_000)
    assert time.process_time() - start < 5


def test_records_are_linked(spark):
    page = spark.createDataFrame([(1, "http://a.example/x", HTML)], PAGE)
    conv, meta = sorted(warc.digest(page).collect(), key=lambda r: r["warc_type"])
    response = warc.responses(page).first()
    assert meta["refers_to"] == conv["refers_to"] == response["record_id"]
    assert meta["concurrent_to"] == conv["record_id"] and conv["concurrent_to"] == meta["record_id"]
    assert conv["block"] == warc.read_page(HTML)[0]
    for r in (meta, conv):
        data = r["block"].encode()
        assert r["block_digest"] == sha1(data) and r["content_length"] == len(data)
        assert r["payload_digest"] == sha1(HTML.encode()) and r["target_uri"] == "http://a.example/x"
        assert f"WARC-Refers-To: {r['refers_to']}" in r["warc_header"].split("\r\n")
    facts = meta["block"].split("\r\n")
    assert "title: A & B" in facts and "outlink: /l?a=1&b=2" in facts
    assert "source-header: Content-Type: text/html; charset=utf-8" in facts and f"source-payload-digest: {sha1(HTML.encode())}" in facts


def test_serialised_members_hold_the_records(spark):
    page = spark.createDataFrame([(1, "http://a.example/x", HTML), (2, None, None)], PAGE)
    records = warc.derivatives(warc.responses(page))
    members = {r["record_id"]: gzip.decompress(r["member"]).decode() for r in warc.serialised(records).collect()}
    for r in records.collect():
        head, rest = members[r["record_id"]].split("\r\n\r\n", 1)
        assert head.startswith("WARC/1.1\r\n") and rest == r["block"] + "\r\n\r\n"
        assert ("WARC-Target-URI" in head) == (r["page_id"] == 1)


def test_awkward_pages(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>x"), (2, "u", "<p>x"), (3, "", "<p>" + "long é " * 50_000)]
    pages = spark.createDataFrame(rows, PAGE).selectExpr("*", "'x' AS block", "1 AS record_id", "2 AS payload")
    got = warc.digest(pages).collect()
    assert len(got) == 2 * len(rows)
    twice = [r["record_id"] for r in got if r["page_id"] == 2]
    assert len(twice) == 4 and len(set(twice)) == 2
    assert {r["block"] for r in got if r["page_id"] == 1 and r["warc_type"] == "conversion"} == {""}
    assert warc.digest(spark.createDataFrame([], PAGE)).collect() == []


def test_unclosed_elements_hide_nothing():
    for name in ("noscript", "svg", "object", "template"):
        text, _, _, links = warc.read_page(f"<p>one<{name}>two</p><a href=/x>three</a><{name}>four")
        assert text.split() == ["onetwo", "threefour"] and links == ["/x"], name
    assert warc.read_page("<p>one<script>two<p>three")[0] == "one"
    assert warc.read_page("<p>a<svg>b</svg>c<svg>d")[0] == "acd"
    start = time.process_time()
    warc.read_page("<svg>x" * 200_000)
    assert time.process_time() - start < 5


class Reader(HTMLParser):
    """Text of a page, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.hidden, self.title, self.out = 0, False, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in warc.HIDDEN
        self.title = self.title or tag == "title"
        self.out.append("\n" if tag in warc.BLOCKS else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in warc.HIDDEN
        self.title = self.title and tag != "title"
        self.out.append("\n" if tag in warc.BLOCKS else "")

    def handle_data(self, data):
        if not self.hidden and not self.title:
            self.out.append(data.replace("\n", " "))


def test_whole_table_like_the_standard_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    blocks = {r["refers_to"]: r["block"] for r in warc.digest(pages).where("warc_type = 'conversion'").collect()}
    for r in warc.responses(pages).collect():
        reader = Reader()
        reader.feed(r["payload"] or "")
        reader.close()
        lines = (" ".join(x.split()) for x in "".join(reader.out).split("\n"))
        assert blocks[r["record_id"]] == "\n".join(x for x in lines if x)
