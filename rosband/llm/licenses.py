"""Operator 5: license scans by template-markup matching.

A template is license wording with two marks: ``<<optional>> ... <<end>>`` may be left out (and may be nested),
``<<any a-b>>`` stands for ``a`` to ``b`` words of the licensee's own.  ``compile_template`` turns it into an automaton
over words; wording is compared word by word, so punctuation and case never matter, and a place is accepted
only if every mandatory word stands there in order.  Automata run at the places where the template's opening words
(mandatory by construction) stand, and report the longest accepted stretch from there.

Beside the templates there are phrases: plain words that label a text wherever they stand consecutively.

Distribution: rows are independent; one ``mapInArrow`` without a shuffle.

Defined cases: a null text has no words; texts of any length are scanned whole; an automaton is quit when no state
is left, so a long text costs time in proportion to its length and to the lengths of accepted stretches; repeated
rows, empty tables and extra columns need no care.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES: dict[str, str] = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Public license wording, with optional and replaceable regions.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files <<optional>> the software <<end>> to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
        "software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice <<optional>> including the next paragraph <<end>> shall be "
        "included in all copies or substantial portions of the software the software is provided as is without warranty of "
        "any kind express or implied including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement in no event shall <<any 1-12>> be liable for any claim damages or other "
        "liability whether in an action of contract tort or otherwise arising from out of or in connection with the "
        "software or the use or other dealings in the software",
        "released under the mit license",
        "licensed under the <<optional>> terms of the <<end>> mit license",
    ),
    "apache-2": (
        "licensed under the apache license version 2 0 <<optional>> the license <<end>> <<optional>> you may not use this "
        "file except in compliance with the license <<optional>> you may obtain a copy of the license at "
        "<<any 1-8>> <<end>> unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied <<end>>",
    ),
    "cc-by-nc": (
        "licensed under <<optional>> a <<end>> cc by nc <<optional>> 4 0 <<end>> <<optional>> license <<end>>",
        "creative commons attribution noncommercial <<any 0-2>> international license",
    ),
    "cc-by": ("licensed under <<optional>> a <<end>> cc by 4 0", "creative commons attribution 4 0 international license"),
    "gpl-3": (
        "licensed under the gnu general public license <<optional>> as published by the free software foundation <<end>> "
        "<<optional>> either <<end>> version 3 <<optional>> 0 <<end>> <<optional>> of the license <<end>>",
        "under the terms of the gnu general public license as published by the free software foundation "
        "<<optional>> either <<end>> version 3 of the license",
    ),
    "lgpl-3": ("licensed under the gnu lesser general public license <<optional>> as published by the free software "
               "foundation <<end>> <<optional>> either <<end>> version 3",),
    "bsd-3-clause": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met <<any 0-1>> redistributions of source code must retain the above copyright notice this "
        "list of conditions and the following disclaimer <<any 0-1>> redistributions in binary form must reproduce the above "
        "copyright notice this list of conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution <<any 0-1>> neither the name of <<any 1-12>> nor the names of its contributors may be "
        "used to endorse or promote products derived from this software without specific prior written permission",
    ),
    "mpl-2": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
}

_MARK = re.compile(r"<<(optional|end|any (\d+)-(\d+))>>|(\S+)")
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A to Z) words: runs of other bytes than ASCII punctuation, spaces and controls."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Automaton:
    """A token automaton: ``step[state]`` by word, ``free[state]`` for any word, ``skip[state]`` without a word."""

    def __init__(self) -> None:
        self.step: list[dict[bytes, int]] = []
        self.free: list[int | None] = []
        self.skip: list[list[int]] = []
        self.opening: list[bytes] = []
        self.end = 0

    def state(self) -> int:
        self.step.append({})
        self.free.append(None)
        self.skip.append([])
        return len(self.step) - 1

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def longest(self, words: list[bytes], at: int) -> int | None:
        """End of the longest accepted stretch of ``words`` from ``at`` on, or None."""
        states, best = self.closure({0}), None
        while True:
            if self.end in states:
                best = at
            if at >= len(words):
                return best
            w = words[at]
            nxt = {t for s in states if (t := self.step[s].get(w)) is not None}
            nxt |= {t for s in states if (t := self.free[s]) is not None}
            if not nxt:
                return best
            states, at = self.closure(nxt), at + 1


def compile_template(template: str) -> Automaton:
    a = Automaton()
    now, open_at, plain = a.state(), [], True
    for mark, least, most, word in _MARK.findall(template):
        if word:
            token = word.lower().encode()
            nxt = a.state()
            a.step[now][token] = nxt
            now = nxt
            if plain:
                a.opening.append(token)
            continue
        plain = False
        if mark == "optional":
            fresh = a.state()  # an own state, so that a skip never leads into another region's words
            a.skip[now].append(fresh)
            open_at.append(fresh)
            now = fresh
        elif mark == "end":
            nxt = a.state()
            a.skip[now].append(nxt)
            a.skip[open_at.pop()].append(nxt)
            now = nxt
        else:
            for n in range(int(most)):
                nxt = a.state()
                a.free[now] = nxt
                if n >= int(least):
                    a.skip[now].append(nxt)
                now = nxt
    if open_at or not a.opening:
        raise ValueError("a template opens with mandatory words and closes its regions")
    a.end = now
    return a


class Scanner:
    """Finds phrases and template places in the words of a text."""

    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, tuple[str, ...]]):
        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]
        self.automata = [(compile_template(t), label) for label, ts in templates.items() for t in ts]
        self.openings = [(b" " + b" ".join(a.opening) + b" ", a, label) for a, label in self.automata]

    @staticmethod
    def _places(joined: bytes, needle: bytes) -> Iterator[int]:
        """Word numbers where the spaced words of ``needle`` begin."""
        at, seen, n = joined.find(needle), 0, 0
        while at >= 0:
            n += joined.count(b" ", seen, at)
            seen = at
            yield n
            at = joined.find(needle, at + 1)

    def scan(self, text: str | None) -> dict:
        words = words_of(text or "")
        joined = b" " + b" ".join(words) + b" "
        base = [(n, len(p.split()), label) for p, label in self.phrases for n in self._places(joined, p)]
        found = []
        for needle, automaton, label in self.openings:
            for n in self._places(joined, needle):
                end = automaton.longest(words, n)
                if end is not None:
                    found.append({"label": label, "first": n, "end": end})
        covered, upto = 0, 0
        for a, b in sorted([(n, n + k) for n, k, _ in base] + [(x["first"], x["end"]) for x in found]):
            covered += max(0, b - max(a, upto))
            upto = max(upto, b)
        starts = [n for n, _, _ in base]
        labels = {label for _, _, label in base}
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(labels)),
            "labels": ",".join(sorted(labels | {x["label"] for x in found})),
            "score": covered / len(words) if words else 0.0,
            "places": sorted(found, key=lambda x: (x["first"], x["label"], x["end"])),
        }


_TYPE = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("places", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))),
])


def scan(
    docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, tuple[str, ...]] = TEMPLATES
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places`` of every row.

    ``score`` is the share of the words that stand in accepted wording; ``places`` are the template places (first word,
    word after the last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for batch in batches:
            rows = pa.array([scanner.scan(x.as_py()) for x in batch.column("text")], _TYPE)
            names = [f.name for f in _TYPE]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(rows.field(n) for n in names)], ["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, places array<struct<label: string, first: long, end: long>>",
    )


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs).drop("places")
