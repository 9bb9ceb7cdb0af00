"""Operator 4: quality rules with cross-document line frequency.

Base rules look at one text: its words, symbols, repeated lines and repeated 8-word windows.  The
method looks across documents: lines are normalised and hashed; per host (``source``) it counts the
distinct documents that carry a line; a line carried by more than ``max_docs`` documents is above the limit, in
a small host by more than ``share`` of its documents (never by ``min_docs`` or fewer), and is removed from all of them
but the first (smallest doc_id); a document that keeps less than ``keep_words`` of its words is depleted and
rejected.  The limit does not grow with the host, so a footer of a large host goes as surely as one of a small host.

Documents with equal texts count as one document of the host, both for a line's count and for the
host's size: a group of copies is for near-duplicate removal to thin out, and must not turn its own
text into boilerplate and vanish altogether.

Distribution: one Python pass over the texts gives counts and line hashes (written once, without the
texts); all counting is DataFrame aggregation on (host, line), pre-aggregated by Spark before each
shuffle, so a line that nearly every document carries arrives as one partial row per task.

Defined cases: a null text is an empty text (no words, base_failed); rows with a null source share one
host; a null doc_id counts as the largest; rows that share doc_id and text are one document and get the
same verdict; extra columns are ignored by ``verdicts`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosband.llm.common import text_or_empty, written
from rosband.llm.lines import line_hash, line_words

#: A line is above the limit in a host when more documents than this carry it,
MAX_DOCS = 40
#: or, where that is less, more than this share of the host's documents,
HOST_SHARE = 0.1
#: but never when so many or fewer do.
MIN_DOCS = 10
#: Share of a document's words that must be left.
KEEP_WORDS = 0.3
_LAST_ID = (1 << 63) - 1
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_WINDOW = 8

_LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32()), ("at", pa.list_(pa.int32()))]))


def repeated_words(words: list[bytes], window: int = _WINDOW) -> int:
    """Words that lie in a window of ``window`` (a power of two) words found twice or more.

    Windows get exact ranks by doubling: equal ranks of both halves mean equal windows."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    count, size = len(seen), 1
    while size < window:
        if count == len(rank):
            return 0
        pairs = rank[:-size] * count + rank[size:]
        distinct, rank = np.unique(pairs, return_inverse=True)
        count, size = len(distinct), 2 * size
    if count == len(rank):
        return 0
    again = np.flatnonzero(np.bincount(rank, minlength=count)[rank] > 1)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(text: str) -> tuple[int, int, int, int, int, list[dict]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the distinct normalised lines."""
    words = text.encode("utf-8", "surrogatepass").split()
    word_chars = len(text) - sum(map(text.count, _SPACES))
    lines: dict[int, dict] = {}
    raw: set[str] = set()
    dup = 0
    for at, line in enumerate(text.split("\n")):
        own = line_words(line)
        if not own:
            continue
        dup += line in raw
        raw.add(line)
        h = line_hash(own)
        entry = lines.setdefault(h, {"line": h, "words": 0, "at": []})
        entry["words"] += len(own)
        entry["at"].append(at)
    return len(words), word_chars, sum(map(text.count, _SYMBOLS)), dup, repeated_words(words), list(lines.values())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for batch in batches:
        rows = [text_counts(x.as_py()) for x in batch.column("text")]
        cols = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in ("doc_id", "text_hash", "host")]
            + [pa.array(c, pa.int64()) for c in cols[:5]]
            + [pa.array(list(cols[5]), _LINES)],
            ["doc_id", "text_hash", "host", *names, "lines"],
        )


def counts(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` the base counts and the distinct normalised lines with their places."""
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
    ).withColumn("text_hash", F.xxhash64("text"))
    return keyed.mapInArrow(
        _counted,
        "doc_id long, text_hash long, host string, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, lines array<struct<line: long, words: int, at: array<int>>>",
    )


def lines_above(
    counted: DataFrame, min_docs: int = MIN_DOCS, share: float = HOST_SHARE, max_docs: int = MAX_DOCS
) -> DataFrame:
    """``host, line, first_key``: the lines above the limit and the document that keeps them."""
    key = F.coalesce("doc_id", F.lit(_LAST_ID)).alias("key")
    lines = counted.select("host", "text_hash", key, F.explode("lines.line").alias("line"))
    texts = lines.groupBy("host", "line", "text_hash").agg(F.min("key").alias("key"))
    carried = texts.groupBy("host", "line").agg(F.count("*").alias("n"), F.min("key").alias("first_key"))
    sizes = counted.groupBy("host", "text_hash").agg(F.lit(1)).groupBy("host").agg(F.count("*").alias("docs"))
    return (
        carried.where(F.col("n") > min_docs)
        .join(sizes, "host")
        .where((F.col("n") > max_docs) | (F.col("n") > share * F.col("docs")))
        .select("host", "line", "first_key")
    )


def verdicts(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    share: float = HOST_SHARE,
    keep_words: float = KEEP_WORDS,
    max_docs: int = MAX_DOCS,
) -> DataFrame:
    """Per row of ``docs``: the base counts, ``removed_words``, ``removed_at`` (line numbers) and ``kept``."""
    counted = written(counts(docs))
    key = F.coalesce("doc_id", F.lit(_LAST_ID))
    above = lines_above(counted, min_docs, share, max_docs)
    carried = counted.select("host", "text_hash", key.alias("key"), F.inline("lines"))
    removed = (
        carried.join(above, ["host", "line"])
        .where("key <> first_key")
        .groupBy("host", "key", "text_hash", "line")
        .agg(F.first("words").alias("words"), F.first("at").alias("at"))
        .groupBy("host", "key", "text_hash")
        .agg(F.sum("words").alias("removed_words"), F.array_sort(F.flatten(F.collect_list("at"))).alias("removed_at"))
    )
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = F.col("n_words") - F.col("removed_words") < keep_words * F.col("n_words")
    return (
        counted.drop("lines")
        .withColumn("key", key)
        .join(removed, ["host", "key", "text_hash"], "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~base_failed & ~((F.col("removed_words") > 0) & depleted))
    )


def keep(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, without their lines above the limit (``n_chars`` follows the text)."""
    v = verdicts(docs, **limits).where("kept")
    v = v.groupBy("key", "text_hash", F.col("host").alias("__llm_host")).agg(F.first("removed_at").alias("__llm_removed"))
    v = v.select(F.col("key").alias("__llm_key"), F.col("text_hash").alias("__llm_hash"), "__llm_host", "__llm_removed")
    text = text_or_empty()
    keyed = docs.withColumns({
        "__llm_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)),
        "__llm_hash": F.xxhash64(text),
        "__llm_host": F.coalesce(F.col("source").cast("string"), F.lit("")),
    })
    left = F.filter(F.split(text, "\n", -1), lambda line, at: ~F.array_contains("__llm_removed", at))
    out = keyed.join(v, ["__llm_key", "__llm_hash", "__llm_host"]).withColumn(
        "text", F.when(F.col("__llm_removed").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    )
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__llm_removed").isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return out.select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    return verdicts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_words",
    )
