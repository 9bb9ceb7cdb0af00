"""Operator 8: line dedup by winnowing over line hashes.

A document is the sequence of the hashes of its normalised lines (lines without a word are passed
over).  A window starts at every line and takes lines until it has ``min_words`` words; the least hash in
it is its fingerprint, so every run of lines with ``min_words`` words or more holds a whole window and
with it a fingerprint that all its copies select too.  Fingerprints that are selected at one place only
are dropped; the windows of the others are joined by their content with the first place (smallest
doc_id, then line) that has the window.  Each pair of places is an alignment of two documents, which is
extended both ways while lines are equal.  What a document shares with an earlier place in such a run is
deleted; the first place of a run keeps it.

``dedup`` deletes these runs of whole lines.  ``dedup_passages`` (the registered query and the pipeline) deletes them and
goes on by words (``passages``) with what they leave: passages that begin or end inside a line.

Distribution: windows and sequences are written once, without texts.  Every repeat is joined with one
first place only, never with the other repeats, so a passage that thousands of documents share makes
thousands of pairs and not their square.  Joins are sort-merge joins that Spark's adaptive execution may
split at hot passages.

Defined cases: a null text stays null and has no lines; texts with fewer than ``min_words`` words have no
window and stay; a null doc_id counts as the largest; rows that share doc_id and text are one document
and get the same result; a document whose lines all go keeps its row with what is left (blank lines);
extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosband.llm import passages
from rosband.llm.common import text_or_empty, written

#: Words that a repeated run must have at least.
MIN_WORDS = 50

_WINDOW = np.dtype([("mark", "i8"), ("start", "i4"), ("end", "i4"), ("fresh", "?")])


def windows(hashes: Sequence[int], sizes: Sequence[int], min_words: int, stop: np.ndarray | None = None) -> np.ndarray:
    """Per line the shortest window from it on that has ``min_words`` words: its least hash (mark; the last of equal
    ones), first and last line; ``fresh`` where the mark is at another place than in the window before.

    ``hashes`` and ``sizes`` are those of the lines of texts that stand one after the other; ``stop`` has for each line the
    end of its text (one text: may be left out).  Lines from which a text has too few words have no window."""
    hashes = np.asarray(hashes, np.int64)
    n = len(hashes)
    upto = np.concatenate(([0], np.cumsum(np.asarray(sizes, np.int64))))
    end = np.searchsorted(upto, upto[:-1] + min_words)
    start = np.flatnonzero(end <= (n if stop is None else stop))
    out = np.zeros(len(start), _WINDOW)
    if not len(start):
        return out
    end = end[start]
    level = np.frexp(end - start)[1] - 1
    least, place = np.arange(n), np.zeros(len(start), np.int64)
    for k in range(level.max() + 1):
        here = np.flatnonzero(level == k)
        a, b = least[start[here]], least[end[here] - (1 << k)]
        place[here] = np.where(hashes[b] <= hashes[a], b, a)
        a, b = least[: -(1 << k)], least[1 << k :]
        least = np.where(hashes[b] <= hashes[a], b, a)
    out["mark"], out["start"], out["end"] = hashes[place], start, end - 1
    out["fresh"] = np.concatenate(([True], place[1:] != place[:-1]))
    return out


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), values)


def _sequences(docs: DataFrame, min_words: int) -> DataFrame:
    """``lines`` (hashes), ``at`` (first word of each line and the number of words) and ``windows`` of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in passages.together(texts):
                sums = passages.Sums(texts[a:b])
                text, first, last = sums.lines()
                hashes = sums.runs(first, last)
                upto = np.searchsorted(text, np.arange(b - a + 1))
                found = windows(hashes.view(np.int64), last - first, min_words, upto[1:][text])
                begin, of = upto[:-1], text[found["start"]]
                # of lines, not of words: equal windows are cut into the same lines
                content = passages.Runs(hashes).runs(found["start"], found["end"] + 1).view(np.int64)
                found_lines = [(found[c] - begin[of]).astype(np.int32) for c in ("start", "end")]
                columns = [pa.array(found["mark"]), pa.array(content), *map(pa.array, found_lines), pa.array(found["fresh"])]
                at = np.insert(first - sums.first[text], upto[1:], sums.n).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(a, b - a),
                        batch.column("text_hash").slice(a, b - a),
                        _lists(np.diff(upto), pa.array(hashes.view(np.int64))),
                        _lists(np.diff(upto) + 1, pa.array(at)),
                        _lists(
                            np.bincount(of, minlength=b - a),
                            pa.StructArray.from_arrays(columns, ["mark", "content", "start", "end", "fresh"]),
                        ),
                    ],
                    ["key", "text_hash", "lines", "at", "windows"],
                )

    return passages.keyed(docs).mapInArrow(
        run,
        "key long, text_hash long, lines array<long>, at array<int>, "
        "windows array<struct<mark: long, content: long, start: int, end: int, fresh: boolean>>",
    )


def extend(own: np.ndarray, first: np.ndarray, shift: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First lines and ends of the runs of ``own`` that hold a line of ``starts`` and equal ``first`` moved by ``shift``
    (line ``i`` of ``own`` stands against line ``i - shift`` of ``first``): windows, extended both ways."""
    lo, hi = max(0, shift), min(len(own), len(first) + shift)
    same = np.concatenate(([False], own[lo:hi] == first[lo - shift : hi - shift], [False]))
    edges = np.flatnonzero(same[1:] != same[:-1]) + lo
    runs = np.unique(np.searchsorted(edges[0::2], starts, "right")) - 1
    return edges[0::2][runs], edges[1::2][runs]


def _values(column: pa.ListArray) -> tuple[np.ndarray, list[int]]:
    """Values of all lists together and where each list begins and ends."""
    return column.flatten().to_numpy(), [0, *np.cumsum(column.value_lengths().to_numpy()).tolist()]


def _extended(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        (own, o), (first, f), (at, t), (starts, s) = (_values(batch.column(n)) for n in ("lines", "first_lines", "at", "starts"))
        lo, hi, counts = [], [], []
        for i, shift in enumerate(batch.column("shift").to_pylist()):
            begin, end = extend(own[o[i] : o[i + 1]], first[f[i] : f[i + 1]], shift, starts[s[i] : s[i + 1]])
            word = at[t[i] : t[i + 1]]
            lo.append(word[begin])
            hi.append(word[end] - min_words)
            counts.append(len(begin))
        spans = [pa.array(np.concatenate(x).astype(np.int32) if x else [], pa.int32()) for x in (lo, hi)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("text_hash"), _lists(counts, pa.StructArray.from_arrays(spans, ["lo", "hi"]))],
            ["key", "text_hash", "spans"],
        )


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``key, text_hash, spans``: per document with a later repeat its runs of lines, as the words ``lo`` to ``hi`` (from 0)
    from which ``min_words`` words of the run go."""
    seqs = written(_sequences(docs, min_words))
    places = seqs.select("key", "text_hash", F.inline("windows"))
    marks = written(places.groupBy("mark").agg(F.sum(F.col("fresh").cast("long")).alias("n")).where("n > 1").select("mark"))
    shared = places.join(marks, "mark", "left_semi").select("content", "key", "text_hash", "start")
    shared = written(shared)
    first = shared.groupBy("content").agg(F.min(F.struct("key", "text_hash", "start")).alias("first"), F.count("*").alias("n"))
    pairs = (
        shared.join(first.where("n > 1"), "content")
        .where("struct(key, text_hash, start) <> first")
        .groupBy("key", "text_hash", F.col("first.key").alias("first_key"), F.col("first.text_hash").alias("first_hash"),
                 (F.col("start") - F.col("first.start")).alias("shift"))
        .agg(F.collect_set("start").alias("starts"))
    )
    pairs = written(pairs)
    # rows that share key and text are one document; only those of a pair are moved for that
    both = pairs.select("key", "text_hash").unionAll(pairs.select("first_key", "first_hash")).distinct()
    own = written(seqs.drop("windows").join(both, ["key", "text_hash"], "left_semi").dropDuplicates(["key", "text_hash"]))
    firsts = own.select(F.col("key").alias("first_key"), F.col("text_hash").alias("first_hash"), F.col("lines").alias("first_lines"))
    aligned = pairs.join(firsts, ["first_key", "first_hash"]).join(own, ["key", "text_hash"])
    runs = aligned.select("key", "text_hash", "lines", "first_lines", "shift", "starts", "at").mapInArrow(
        lambda x: _extended(x, min_words), "key long, text_hash long, spans array<struct<lo: int, hi: int>>"
    )
    return runs.groupBy("key", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, gone: str | None = None) -> DataFrame:
    """``docs`` without later repeated runs of whole lines in ``text`` (``n_chars`` follows the text).  ``gone`` names a column
    for the deleted line numbers (an empty array where nothing was deleted)."""
    return passages.without(docs, repeats(docs, min_words), min_words, gone)


def dedup_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, gone: str | None = None, n_words: str | None = None
) -> DataFrame:
    """``docs`` without later repeated passages: runs of lines, then by words what these leave.  ``gone`` and ``n_words``
    as in ``passages.without``."""
    runs = written(repeats(docs, min_words))
    return passages.without(docs, passages.repeats(docs, min_words, runs), min_words, gone, n_words)


def digest(docs: DataFrame) -> DataFrame:
    """Per document the lines deleted whole (numbers from 0), the words deleted in whole lines or inside one, and the
    SHA-256 of the text that is left (null: empty)."""
    out = dedup_passages(docs.select("doc_id", "text"), gone="gone", n_words="n_words_removed")
    return out.select(
        "doc_id",
        F.size("gone").cast("long").alias("n_removed"),
        "n_words_removed",
        F.array_join("gone", ",").alias("removed_lines"),
        F.sha2(text_or_empty(), 256).alias("text_sha256"),
    )
