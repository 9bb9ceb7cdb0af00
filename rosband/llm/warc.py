"""Operator 6: WARC derivative builder.

Every response record (``record_id, target_uri, warc_date, http_headers, payload``) becomes two records:

* ``metadata`` (application/warc-fields): title, language, outlinks, the response's HTTP headers and the digest of
  its payload;
* ``conversion`` (text/plain): the visible text of the page.

Both keep the response's identifier in WARC-Refers-To, its target URI and date, carry the SHA-1 digest of their own
block (base 32) and name each other in WARC-Concurrent-To.  Identifiers are name-based UUIDs of the response's
identifier and the record type, so building again gives the same records.  ``serialised`` turns a record into the
bytes of a gzip member; members can be written one after the other into a ``.warc.gz`` file.

HTML is read in one pass over its tags (quoted attribute values, comments, scripts and styles included); malformed
markup is read on from where a tag cannot go on, so the time is in proportion to the length.  Content of hidden
elements is no text; where such an element is never closed, script, style, iframe and textarea hide the rest of
the page, the others nothing.

Distribution: rows are independent; one ``mapInArrow`` without a shuffle.

Defined cases: a null payload is an empty page (two records with empty text); a null or empty target URI gives
records without that header; a null page_id is kept; repeated rows give repeated records with equal identifiers;
empty tables give none; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Date of the responses of tables that have none.
DATE = "2024-01-01T00:00:00Z"

# Elements of HTML that stand on lines of their own, and those whose content is not text.
BLOCKS = frozenset(
    "address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html li main nav ol option p pre section summary table tbody td tfoot th thead title tr "
    "ul".split()
)
HIDDEN = frozenset("script style noscript template iframe object svg textarea".split())
#: Those whose content is no markup: without an end tag they reach to the end of the page.
RAW = frozenset("script style iframe textarea".split())

_TAG = re.compile(r"""<(?:(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>?|!--|[!?][^>]*+>?)""")
_HREF = re.compile(r"""(?<![^\s"'/])href\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_LANG = re.compile(r"""(?<![^\s"'/])lang\s*+=\s*+["']?([A-Za-z0-9-]++)""", re.I)


def read_page(page: str) -> tuple[str, str, str, list[str]]:
    """Visible text, title, language and outlinks of a page."""
    text: list[str] = []
    title: list[str] = []
    links: list[str] = []
    unclosed: set[str] = set()
    lang, at, in_title = "", 0, False
    while True:
        m = _TAG.search(page, at)
        piece = page[at : m.start() if m else len(page)]
        if piece:
            if "&" in piece:
                piece = html.unescape(piece)
            if "\n" in piece:
                piece = piece.replace("\n", " ")
            (title if in_title else text).append(piece)
        if not m:
            break
        at = m.end()
        name = m.group(2)
        if name is None:
            if m.group() == "<!--":
                end = page.find("-->", at)
                at = end + 3 if end >= 0 else len(page)
            continue
        name, closing = name.lower(), bool(m.group(1))
        if name == "title":
            in_title = not closing
        elif name in HIDDEN and name not in unclosed and not closing and not m.group(3).endswith("/"):
            end = re.compile(f"</{name}(?![^\\s/>])[^>]*+>?", re.I).search(page, at)
            if end:
                at = end.end()
            elif name in RAW:
                at = len(page)
            else:
                unclosed.add(name)  # the start tag is passed over, here and further on
        elif name == "a" and not closing:
            if href := _HREF.search(m.group(3)):
                links.append(html.unescape(next(g for g in href.groups() if g is not None)).strip())
        elif name == "html" and not closing and (own := _LANG.search(m.group(3))):
            lang = own.group(1)
        if name in BLOCKS:
            text.append("\n")
    lines = (" ".join(x.split()) for x in "".join(text).split("\n"))
    return "\n".join(x for x in lines if x), " ".join("".join(title).split()), lang, links


def sha1_base32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(refers_to: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} of {refers_to}')}>"


_FIELDS = ("warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "warc_date", "content_type", "content_length",
           "block_digest", "payload_digest", "block")
_SCHEMA = ("warc_type string, record_id string, refers_to string, concurrent_to string, target_uri string, warc_date string, "
           "content_type string, content_length long, block_digest string, payload_digest string, block string")  # fmt: skip


def derive(refers_to: str, uri: str | None, date: str, headers: str | None, page: str | None) -> list[tuple]:
    """The metadata and the conversion record of one response, in the order of ``_FIELDS``."""
    page = page or ""
    text, title, lang, links = read_page(page)
    payload = sha1_base32(page.encode("utf-8", "surrogatepass"))
    fields = [("title", title), ("lang", lang), *(("outlink", x) for x in links)]
    status, *rest = (headers or "").splitlines() or [""]
    fields += [("source-status", status), *(("source-header", x) for x in rest), ("source-payload-digest", payload)]
    facts = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields if v)
    ids = {k: record_id(refers_to, k) for k in ("metadata", "conversion")}
    out = []
    for kind, other, form, block in (
        ("metadata", "conversion", "application/warc-fields", facts),
        ("conversion", "metadata", "text/plain; charset=utf-8", text),
    ):
        data = block.encode("utf-8", "surrogatepass")
        out.append((kind, ids[kind], refers_to, ids[other], uri or None, date, form, len(data), sha1_base32(data), payload, block))
    return out


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of raw pages (page_id, url, html), as a crawl would have stored them."""
    page = F.coalesce(F.col("html"), F.lit(""))
    name = F.sha2(F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), page), 256)
    part = lambda a, n: F.substring(name, a, n)
    urn = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))
    headers = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(page).cast("string")
    )
    return pages.select(
        "page_id", urn.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"),
        headers.alias("http_headers"), F.col("html").alias("payload"),
    )


def derivatives(records: DataFrame) -> DataFrame:
    """``page_id`` and the fields of two records for every response record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in ("record_id", "target_uri", "warc_date", "http_headers", "payload")]
            rows = [r for x in zip(*cols, strict=True) for r in derive(*x)]
            ids = pa.array([i for i in batch.column("page_id").to_pylist() for _ in range(2)], pa.int64())
            made = list(zip(*rows, strict=True)) or [()] * len(_FIELDS)
            types = [pa.int64() if n == "content_length" else pa.string() for n in _FIELDS]
            arrays = [pa.array(c, t) for c, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *arrays], ["page_id", *_FIELDS])

    needed = ["record_id", "target_uri", "warc_date", "http_headers", "payload"]
    return records.select(F.col("page_id").cast("long"), *needed).mapInArrow(run, f"page_id long, {_SCHEMA}")


def header_block() -> Column:
    """The WARC header lines of a derived record."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)  # noqa: E731  null values leave the line out
    return F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("warc_date")), line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Refers-To", F.col("refers_to")), line("WARC-Concurrent-To", F.col("concurrent_to")),
        line("WARC-Block-Digest", F.col("block_digest")), line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")),
    )


def serialised(records: DataFrame) -> DataFrame:
    """``page_id, record_id, member``: the gzip member of every record (header, empty line, block, two empty lines)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = [gzip.compress(x.as_py().encode("utf-8", "surrogatepass"), mtime=0) for x in batch.column("record")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("record_id"), pa.array(members, pa.binary())], ["page_id", "record_id", "member"]
            )

    whole = F.concat(header_block(), F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n\r\n")).alias("record")
    return records.select("page_id", "record_id", whole).mapInArrow(run, "page_id long, record_id string, member binary")


def digest(pages: DataFrame) -> DataFrame:
    """All derived records of raw pages with their WARC header lines."""
    return derivatives(responses(pages)).withColumn("warc_header", header_block())
