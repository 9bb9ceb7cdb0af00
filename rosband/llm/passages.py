"""Repeated passages, for operator 8: winnowing over the words of whole texts, lines or not.

``winnow`` finds the runs of lines; here follows what begins or ends inside a line.

A document is the sequence of its normalised words (as in ``lines``, over line ends).  A window is ``min_words``
words.  A word goes if it lies in a window that also stands at an earlier place (smaller doc_id, then text hash,
then word); the first place keeps it.  So a passage of ``min_words`` words goes wherever in a line it begins
and ends, up to its last equal word on both sides.

Within a window the least hash of ``gram`` consecutive words is its mark, so equal windows have equal marks.  The
windows of one place of a mark follow each other and are one row with the hash of all their words.  Only marks
at two places or more go on.  A row whose words stand at an earlier place goes whole; where a mark has rows of
different words, the first row of each is taken apart into its windows, which are compared by content.  A passage that
thousands of documents share is thus one row a mark and document, and only its ends are taken apart.

Lines whose words all go are deleted, in others the words with the space behind them (at a line's end: before them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosband.llm.common import text_or_empty, written

_LAST_ID = (1 << 63) - 1
#: What ``line_words`` splits at.
_SPACE = re.compile(rb"[ \t-\r]")
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_BASE, _BYTE_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_INVERSE, _BYTE_INVERSE = pow(_BASE, -1, 1 << 64), pow(_BYTE_BASE, -1, 1 << 64)
#: Rows of a batch that goes out, and bytes of the texts that are hashed together.
_PIECE, _BYTES = 1 << 16, 1 << 18
_LOW = np.uint64((1 << 32) - 1)

_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; the longest table asked for so far is kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(1 << max(n - 1, 1).bit_length(), base, np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def _mixed(x: np.ndarray, length: np.ndarray) -> np.ndarray:
    x = x + length.astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of bytes that begin and end with a space."""
    space = _IS_SPACE[data]
    at = np.flatnonzero(space[1:] != space[:-1]) + 1
    return at[0::2], at[1::2]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the words of lower-cased text, split as by ``line_words``, runs of digits as one 0."""
    places, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(data):
        cut = _SPACE.search(data, at + _BYTES)
        end = cut.start() if cut else len(data)
        x = np.frombuffer(b" %b " % data[at:end], np.uint8)
        start, stop = _edges(x)
        places.append(start + (at - 1))
        digit = (x - np.uint8(48)) < 10
        if digit.any():
            x = np.where(digit, np.uint8(48), x)
            again = digit[1:] & digit[:-1]
            if again.any():
                x = x[np.concatenate(([True], ~again))]
                start, stop = _edges(x)
        upto = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * _powers(_BYTE_BASE, len(x)), dtype=np.uint64, out=upto[1:])
        hashes.append(_mixed((upto[stop] - upto[start]) * _powers(_BYTE_INVERSE, len(x))[start], stop - start))
        at = end
    return np.concatenate(places), np.concatenate(hashes)


class Runs:
    """Hashes of any run of a sequence of hashes (polynomial, modulo 2**64)."""

    def __init__(self, hashes: np.ndarray):
        self.upto = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * _powers(_BASE, len(hashes)), dtype=np.uint64, out=self.upto[1:])
        self.back = _powers(_INVERSE, len(hashes) + 1)

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.upto[end] - self.upto[start]) * self.back[start], end - start)


class Sums(Runs):
    """Hashes of any run of words of texts that stand one after the other: text ``i`` has the ``n[i]`` words from
    ``first[i]`` on."""

    def __init__(self, texts: list[str]):
        data = [x.lower().encode("utf-8", "surrogatepass") for x in texts]
        ends = np.cumsum([len(x) + 1 for x in data])
        self.data = b" ".join(data)
        self.places, hashes = word_hashes(self.data)
        upto = np.searchsorted(self.places, np.concatenate(([0], ends)))
        self.first, self.n = upto[:-1], np.diff(upto)
        super().__init__(hashes)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``text, first, last``: of every line with a word its text, its first word and the end of its words."""
        breaks = np.flatnonzero(np.frombuffer(self.data, np.uint8) == 10)
        upto = np.unique(np.concatenate(([0], np.searchsorted(self.places, breaks), self.first + self.n)))
        return np.searchsorted(self.first + self.n, upto[:-1], "right"), upto[:-1], upto[1:]


def gram_size(min_words: int) -> int:
    return max(1, 2 * min_words // 5)


def marks(sums: Sums, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``text, mark, whole, lo, hi``: for each place of a mark the text, the first and last start of its windows (words of
    the text, from 0) and the hash of their words."""
    gram = gram_size(min_words)
    width = min_words - gram + 1
    text = np.repeat(np.arange(len(sums.n)), sums.n)
    start = np.flatnonzero(np.arange(len(text)) + min_words <= (sums.first + sums.n)[text])
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    at = np.arange(len(text) - gram + 1)
    hashes = sums.runs(at, at + gram)
    # the least of ``size`` hashes from a place on, with its place below: the last of equal ones
    best, size = (hashes & ~_LOW) | (_LOW - at.astype(np.uint64)), 1
    while size < width:
        step = min(size, width - size)
        best = np.minimum(best[:-step], best[step:])
        size += step
    best = best[start] & _LOW  # a window's mark is in its own text, so texts do not share places
    new = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
    lo, hi = start[new], start[np.concatenate((new[1:], [len(start)])) - 1]
    text = text[lo]
    first = sums.first[text]
    mark = hashes[(_LOW - best[new]).astype(np.int64)]
    return text, mark, sums.runs(lo, hi + min_words), lo - first, hi - first


def together(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``_BYTES`` characters or one longer text."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _places(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    names = ["key", "text_hash", "mark", "whole", "lo", "hi"]
    for batch in batches:
        key, text_hash = (batch.column(n).to_numpy() for n in names[:2])
        texts = batch.column("text").to_pylist()
        for a, b in together(texts):
            text, mark, whole, lo, hi = marks(Sums(texts[a:b]), min_words)
            for at in range(0, len(text), _PIECE):
                part = slice(at, at + _PIECE)
                row = text[part] + a
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[row]), pa.array(text_hash[row]), pa.array(mark[part].view(np.int64)),
                     pa.array(whole[part].view(np.int64)), pa.array(lo[part].astype(np.int32)),
                     pa.array(hi[part].astype(np.int32))],
                    names,
                )


def _windows(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, text_hash = (batch.column(n).to_numpy() for n in ("key", "text_hash"))
        texts, spans = batch.column("text").to_pylist(), batch.column("spans")
        lo, hi = (spans.flatten().field(n).to_numpy().astype(np.int64) for n in ("lo", "hi"))
        upto = np.concatenate(([0], np.cumsum(spans.value_lengths().to_numpy())))
        for a, b in together(texts):
            sums = Sums(texts[a:b])
            own = slice(upto[a], upto[b])
            n = hi[own] - lo[own] + 1
            text = np.repeat(np.repeat(np.arange(b - a), np.diff(upto[a : b + 1])), n)
            start = np.repeat(lo[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
            for at in range(0, len(start), _PIECE):
                part, row = start[at : at + _PIECE], text[at : at + _PIECE]
                place = part + sums.first[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sums.runs(place, place + min_words).view(np.int64)),
                        pa.array(key[row + a]),
                        pa.array(text_hash[row + a]),
                        pa.array(part.astype(np.int32)),
                    ],
                    ["content", "key", "text_hash", "start"],
                )


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(_key().alias("key"), text_or_empty().alias("text")).withColumn("text_hash", F.xxhash64("text"))


def repeats(docs: DataFrame, min_words: int, known: DataFrame | None = None) -> DataFrame:
    """``key, text_hash, spans``: per document with a later repeat the starts ``lo`` to ``hi`` of windows that go.

    ``known`` has such spans that were found before: their windows are not looked at again (the first place of a window is
    never in one of them) and the spans are among those returned."""
    own = F.struct("key", "text_hash", "lo")
    span = F.struct("lo", "hi")
    places = written(
        keyed(docs).mapInArrow(
            lambda x: _places(x, min_words),
            "key long, text_hash long, mark long, whole long, lo int, hi int",
        )
    )
    twice = written(places.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"))
    shared = places.join(twice, "mark", "left_semi")
    if known is not None:
        before = known.withColumnRenamed("spans", "before")
        inside = F.exists("before", lambda x: (x["lo"] <= F.col("lo")) & (F.col("hi") <= x["hi"]))
        shared = shared.join(before, ["key", "text_hash"], "left").where(~F.coalesce(inside, F.lit(False))).drop("before")
    shared = written(shared)
    first = written(shared.groupBy("mark", "whole").agg(F.min(own).alias("first"), F.count("*").alias("n")))
    later = shared.join(first.where("n > 1").select("mark", "whole", "first"), ["mark", "whole"]).where(own != F.col("first"))
    later = later.select("key", "text_hash", "lo", "hi")

    # written, so that the join below reads a plain table and may be split at a hot mark
    mixed = written(first.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"))
    apart = shared.join(first.select("mark", "whole", "first"), ["mark", "whole"]).where(own == F.col("first"))
    apart = apart.join(mixed, "mark", "left_semi").groupBy("key", "text_hash").agg(F.collect_set(span).alias("spans"))
    windows = keyed(docs).join(written(apart), ["key", "text_hash"]).select("key", "text_hash", "text", "spans")
    windows = written(
        windows.mapInArrow(lambda x: _windows(x, min_words), "content long, key long, text_hash long, start int")
    )
    place = F.struct("key", "text_hash", "start")
    least = windows.groupBy("content").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    single = windows.join(written(least), "content").where(place != F.col("first"))
    single = single.select("key", "text_hash", F.col("start").alias("lo"), F.col("start").alias("hi"))
    found = later.unionAll(single)
    if known is not None:
        found = found.unionAll(known.select("key", "text_hash", F.inline("spans")))
    return found.groupBy("key", "text_hash").agg(F.collect_set(span).alias("spans"))


def cut(text: str, spans: list[tuple[int, int]], min_words: int) -> tuple[str, list[int], int]:
    """``text`` without the words of the windows that start at ``lo`` to ``hi`` of ``spans``, the numbers of the lines
    deleted whole and the number of words deleted, in whole lines or not."""
    gone: list[list[int]] = []
    for lo, hi in sorted(spans):
        if gone and lo <= gone[-1][1]:
            gone[-1][1] = max(gone[-1][1], hi + min_words)
        else:
            gone.append([lo, hi + min_words])
    raw = text.encode()
    data = np.frombuffer(b" %b " % raw, np.uint8)
    start, stop = (x - 1 for x in _edges(data))
    ends = [*np.flatnonzero(data == 10) - 1, len(raw)]  # of the lines, in bytes
    upto = np.searchsorted(start, ends)  # words up to the end of each line
    left, lines, at = [], [], 0
    for lo, hi in gone:
        for number in range(*np.searchsorted(upto, [lo, hi - 1], "right") + [0, 1]):
            first, last = int(upto[number - 1]) if number else 0, int(upto[number])
            if first == last:
                continue
            if lo <= first and last <= hi:
                lines.append(int(number))
                cut_from, cut_to = ends[number - 1] + 1 if number else 0, ends[number] + 1
            elif hi < last:
                cut_from, cut_to = start[max(lo, first)], start[hi]
            else:
                cut_from, cut_to = stop[lo - 1], stop[last - 1]
            left.append(raw[at:cut_from])
            at = cut_to
    left.append(raw[at:])
    out = b"".join(left)
    if lines and lines[-1] == len(ends) - 1:
        out = out[:-1]  # the line end before it
    return out.decode(), lines, sum(hi - lo for lo, hi in gone)


def dedup(docs: DataFrame, min_words: int, gone: str | None = None, n_words: str | None = None) -> DataFrame:
    """``docs`` without later repeats of passages, found by words alone; ``gone`` and ``n_words`` as in ``without``."""
    return without(docs, repeats(docs, min_words), min_words, gone, n_words)


def without(docs: DataFrame, found: DataFrame, min_words: int, gone: str | None = None, n_words: str | None = None) -> DataFrame:
    """``docs`` without the words of the spans in ``found`` in ``text`` (``n_chars`` follows the text).  ``gone`` names a column
    for the numbers of the lines deleted whole (an empty array where none is), ``n_words`` one for the words deleted."""

    @F.arrow_udf("struct<text: string, gone: array<int>, n_words: long>")
    def left(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = [
            None if s is None else cut(t, [(x["lo"], x["hi"]) for x in s], min_words)
            for t, s in zip(text.to_pylist(), spans.to_pylist(), strict=True)
        ]
        out = [None if x is None else {"text": x[0], "gone": x[1], "n_words": x[2]} for x in out]
        return pa.array(out, pa.struct([("text", pa.string()), ("gone", pa.list_(pa.int32())), ("n_words", pa.int64())]))

    found = found.select(
        F.col("key").alias("__llm_key"), F.col("text_hash").alias("__llm_hash"), F.col("spans").alias("__llm_spans")
    )
    keyed = docs.withColumns({"__llm_key": _key(), "__llm_hash": F.xxhash64(text_or_empty())})
    out = keyed.join(found, ["__llm_key", "__llm_hash"], "left")
    touched = F.col("__llm_spans").isNotNull()
    out = out.withColumn("__llm_left", left(F.when(touched, F.col("text")), F.col("__llm_spans")))
    out = out.withColumn("text", F.when(touched, F.col("__llm_left.text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(touched, F.length("text")).otherwise(F.col("n_chars")))
    names = [F.col(c) for c in docs.columns if c not in (gone, n_words)]
    if n_words:
        names.append(F.coalesce("__llm_left.n_words", F.lit(0).cast("long")).alias(n_words))
    if gone:
        names.append(F.coalesce("__llm_left.gone", F.array().cast("array<int>")).alias(gone))
    return out.select(*names)
