"""Operator 3: language identification by cross-parsing entropy.

Learning: per language a bounded sample of whole labelled texts (``ROWS`` texts of at most ``ROW_CHARS`` characters; a
language without such a text gives its shortest one) becomes one string and its suffix automaton, which accepts exactly
the substrings of that string.  The bound is each language's own; no text is cut.  Prediction: a text is parsed left to right into phrases, each the longest match with the
automaton (a letter that the sample lacks is a phrase of its own).  Fewer phrases mean that the text is
closer to the language; ``phrases * log2(sample length) / text length`` estimates the bits per character of
coding the text with the sample, and the language that needs the fewest wins (ties: the smaller name).

Texts are read as letters without case; every run of other characters is one space.

Distribution: the sample is chosen by the least hashes of the distinct texts of a language, by top-k windows over
shares of a language and then over their winners; prediction is one ``mapInArrow`` without a shuffle.  In a task many
texts are parsed in lockstep over one transition table; texts are never cut.

Defined cases: null texts and texts without a letter are ``und`` with score 0; without any labelled text every
row is ``und``; a null doc_id is not held out and not learned from; repeated rows are predicted alike and learned from
once; an empty table gives no rows; extra columns pass through ``predict`` and are ignored elsewhere.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosband.llm.common import written

#: Bounds of a language's sample: its rows, and the characters of a row that may be in it.
ROWS = 24
ROW_CHARS = 1_600
#: Letters with a code of their own; the sample's rarer ones are parsed as letters it lacks.
LETTERS = 250
#: Characters parsed in lockstep at a time, and the number of texts below which they are parsed one by one.
_CHARS, _FEW = 1 << 23, 12
_SPACE, _UNKNOWN = 0, 1
_SHARES = 64


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, rows: int = ROWS, row_chars: int = ROW_CHARS) -> DataFrame:
    """``lang, text``: of the distinct labelled texts of at most ``row_chars`` those with the least hashes, ``rows`` a
    language at most; for a language without one its shortest text."""
    learn = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out())
    learn = learn.select(F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("h"), "text")
    size = F.length("text")
    over = F.when(size <= row_chars, F.lit(0)).otherwise(size)
    # first in shares of a language, then over what they leave: the last window holds a bounded number of rows
    keys = learn.select("lang", "h", over.alias("over")).distinct().withColumn("share", F.pmod("h", F.lit(_SHARES)))
    for by in (["lang", "share"], ["lang"]):
        least = Window.partitionBy(*by).orderBy("over", "h")
        keys = keys.withColumn("n", F.row_number().over(least)).where(F.col("n") <= F.when(F.col("over") == 0, rows).otherwise(1))
        keys = keys.drop("n")
    chosen = written(keys.select("lang", "h"))
    texts = learn.join(chosen, ["lang", "h"])
    return texts.dropDuplicates(["lang", "h"]).orderBy("lang", "h").select("lang", "text")


def _folded() -> np.ndarray:
    """Code point -> the code point of its lower-case letter, or 0 for what is not a letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for cp in range(0x110000):
        if unicodedata.category(ch := chr(cp))[0] == "L":
            out[cp] = ord(ch.lower()[0])
    return out


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


class Parser:
    """Counts the phrases of texts for every language of a sample.

    ``table[state + code]`` holds the next state (times the alphabet) and, in its two low bits, the phrases that end
    there: none inside a match, one where a new match begins, one more for a letter that the language lacks."""

    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts)
        self.folded = _folded()
        joined = {k: self._codes_by(self.folded, "\n".join(v)) for k, v in texts.items()}
        letters, n = np.unique(np.concatenate([*joined.values(), np.zeros(0, np.uint32)]), return_counts=True)
        kept = letters[np.lexsort((letters, -n))]
        kept = kept[kept != 0][:LETTERS]
        code_of = np.full(0x110000, _UNKNOWN, dtype=np.uint8)
        code_of[0] = _SPACE
        code_of[kept] = np.arange(len(kept), dtype=np.uint8) + 2
        self.code = code_of[self.folded]  # code point -> code
        self.size = len(kept) + 2
        tables, self.root, self.bits, base = [], [], [], 0
        for k in self.languages:
            codes = [int(c) for c in code_of[joined[k]] if c != _UNKNOWN]
            step = suffix_automaton(codes)
            tables.append(self._table(step, base))
            self.root.append(base * self.size)
            self.bits.append(math.log2(max(2, len(codes))))
            base += len(step)
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)

    @staticmethod
    def _codes_by(table: np.ndarray, text: str) -> np.ndarray:
        """Letters by ``table``; every run of others is one 0, none at the ends."""
        x = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        x = x[(x != 0) | np.concatenate(([False], x[:-1] != 0))]
        return x[:-1] if len(x) and x[-1] == 0 else x

    def _table(self, step: list[dict[int, int]], base: int) -> np.ndarray:
        table = np.empty((len(step), self.size), dtype=np.int32)
        fresh = np.full(self.size, (base * self.size) << 2 | 2, dtype=np.int32)  # a letter it lacks
        for c, t in step[0].items():
            fresh[c] = ((base + t) * self.size) << 2 | 1
        table[:] = fresh
        table[0] -= 1  # nothing ends where nothing has begun
        for s, out in enumerate(step):
            for c, t in out.items():
                table[s, c] = ((base + t) * self.size) << 2
        return table.ravel()

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases by language and text; texts as codes."""
        sizes = np.array([len(x) for x in texts])
        order = np.argsort(-sizes, kind="stable")
        codes = np.concatenate([texts[i] for i in order])
        lengths = sizes[order]
        at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        roots = np.array(self.root, dtype=np.int32)[:, None]
        state = np.repeat(roots, len(texts), axis=1)
        count = np.zeros_like(state, dtype=np.int64)
        table, active, t = self.table, int((lengths > 0).sum()), 0
        while active >= _FEW:
            upto = int(lengths[active - 1])  # all of these are at least so long
            own, n = np.ascontiguousarray(state[:, :active]), np.zeros((len(roots), active), np.int64)
            pos = at[:active] + t
            for _ in range(t, upto):
                got = table[own + codes[pos]]
                n += got & 3
                own = got >> 2
                pos += 1
            state[:, :active] = own
            count[:, :active] += n
            t = upto
            active = int((lengths > t).sum())
        flat = memoryview(table)
        for i in range(active):
            rest = codes[at[i] + t : at[i] + lengths[i]].tolist()
            for k in range(len(roots)):
                s, n = int(state[k, i]), 0
                for c in rest:
                    got = flat[s + c]
                    n += got & 3
                    s = got >> 2
                state[k, i] = s
                count[k, i] += n
        count += state != roots  # the phrase that the end of the text cuts
        out = np.empty_like(count)
        out[:, order] = count
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names: list[str] = ["und"] * len(texts)
        scores = [0.0] * len(texts)
        if not self.languages:
            return names, scores
        bits = np.array(self.bits)[:, None]
        held: list[tuple[int, np.ndarray]] = []

        def flush():
            if not held:
                return
            cost = self.phrases([x for _, x in held]) * bits / np.array([len(x) for _, x in held])
            best = cost.argmin(axis=0)
            two = np.sort(cost, axis=0)[:2]
            margin = 1 - two[0] / two[1] if len(two) > 1 else np.ones(len(held))
            for (i, _), b, m in zip(held, best, margin, strict=True):
                names[i], scores[i] = self.languages[b], float(min(1.0, max(0.0, m)))
            held.clear()

        size = 0
        for i, text in enumerate(texts):
            codes = self._codes_by(self.code, text or "")
            if len(codes):
                held.append((i, codes))
                size += len(codes)
                if size >= _CHARS:
                    flush()
                    size = 0
        flush()
        return names, scores


_WORKER: dict[int, Parser] = {}


def predict(docs: DataFrame, texts: dict[str, list[str]]) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``lang_pred`` and ``score`` in place of ``text``; ``texts``: the sample."""
    shared = docs.sparkSession.sparkContext.broadcast(texts)
    names = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(str(shared.value))
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Parser(shared.value)
        for batch in batches:
            lang, score = _WORKER[key].predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                [*names, "lang_pred", "score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names)
    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double")


def learn(docs: DataFrame, **bounds: int) -> dict[str, list[str]]:
    """The sample by language (bounded: it is held by the driver and broadcast)."""
    texts: dict[str, list[str]] = {}
    for row in sample(docs, **bounds).collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    return texts


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row."""
    texts = learn(docs.select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", "text").withColumn("held_out", held_out())
    return predict(rows, texts).select("doc_id", "held_out", "lang_pred", "score")
